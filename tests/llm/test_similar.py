"""N-gram join, embedding and passage dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from broadsheet.llm import embedding_dedup, ngram_join, suffix_arrays, suffix_dedup


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_groups(rows, spec):
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = {}
    for i, t in rows:
        w = re.findall(ngram_join.SPACED_WORD, t.translate(upper))
        sets[i] = {tuple(w[k:k + spec.width]) for k in range(max(1, len(w) - spec.width + 1))} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    near = [(a, b) for a, b in pairs if spec.den * len(sets[a] & sets[b]) >= spec.num * len(sets[a] | sets[b])]
    comp = smallest_reachable(sets, near)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def crowd(n, seed=3):
    """Texts that differ from one of two templates in a few words, so that groups are large and chained."""
    rng = random.Random(seed)
    base = [[f"b{t}w{k}" for k in range(120)] for t in range(2)]
    out = []
    for i in range(n):
        w = list(base[i % 2])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("crowded", [128, 6])
def test_ngram_groups(spark, odd_docs, no_docs, sf_docs, texts, crowded, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", crowded)
    monkeypatch.setattr(ngram_join, "CHUNK", crowded * 4)
    spec = ngram_join.Spec()
    cases = [(spark.createDataFrame(crowd(150), "doc_id long, text string"), crowd(150))]
    if crowded == 128:
        cases += [(odd_docs, texts[0]), (sf_docs, texts[1])]
    for docs, rows in cases:
        out = ngram_join.components(docs, spec).collect()
        assert len(out) == len(rows)
        want = brute_groups([(i, t) for i, t in rows if i is not None], spec) | {None: (0, None)}
        assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in out)
    if crowded == 128:
        assert ngram_join.components(no_docs, spec).count() == 0


def test_groups_of_a_crowded_tile_hold_two_chunks(spark, monkeypatch):
    """Unlinked texts that share rare shingles: no pandas group takes more than two chunks of rows."""
    from pyspark.sql.group import GroupedData

    monkeypatch.setattr(ngram_join, "CROWD", 8)
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    common = [f"c{k}" for k in range(90)]
    made = [(i, " ".join(common + [f"u{i}x{k}" for k in range(12)])) for i in range(200)]
    made += [(1000 + i, t.replace(f"u{i}x11", "other")) for i, t in made[:20]]
    most, own = [], GroupedData.applyInPandas

    def watched(self, func, schema):
        if func.__name__ in ("bound", "compare"):
            def sizes(group):
                n = int(group["ids"].map(len).sum()) if "ids" in group else len(group)
                return type(group)({"n": [n]})

            most.extend(r.n for r in own(self, sizes, "n long").collect())
        return own(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", watched)
    docs = spark.createDataFrame(made, "doc_id long, text string")
    spec = ngram_join.Spec()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(docs, spec).collect()}
    assert got == brute_groups(made, spec)
    assert most and max(most) <= 4 * 16  # chunks are cut by hash: twice their size at most


def test_sets_are_made_only_where_bitmaps_leave_a_pair(spark, monkeypatch):
    """Long texts that share a rare passage and little else meet in tiles, but their sets are neither made nor moved."""
    shared = " ".join(f"c{k}" for k in range(300))
    made = [(i, shared + " " + " ".join(f"u{i}x{k}" for k in range(1500))) for i in range(12)]
    made += [(100 + i, t + " end") for i, t in made[:2]]
    fetched, own = [], ngram_join._arrays

    def watched(docs, wanted, spec):
        fetched.append({r.id for r in wanted.collect()})
        return own(docs, wanted, spec)

    monkeypatch.setattr(ngram_join, "_arrays", watched)
    docs = spark.createDataFrame(made, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(docs).collect()}
    assert got == brute_groups(made, ngram_join.Spec())
    assert set().union(*fetched) == {0, 1, 100, 101}


def test_one_document_of_each_group_stays(odd_docs):
    kept = ngram_join.keep_representatives(odd_docs, ngram_join.Spec(5, 80, 100))
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "9", "10", "None", "None", "11"])


def test_bitmap_bounds_overlap_from_above():
    rng = np.random.default_rng(2)
    x, y = (np.unique(rng.integers(0, 400, 90).astype(np.uint64)) for _ in range(2))
    maps = [np.bincount((s % np.uint64(1024)).astype(int), minlength=1024) > 0 for s in (x, y)]
    assert len(np.intersect1d(x, y)) <= (len(x) + len(y) - (maps[0] ^ maps[1]).sum()) // 2


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 16))
    rows = [(int(i), (base[i % 40] + rng.normal(size=16) * (0.02 + 0.12 * (i % 3))).tolist()) for i in range(240)]
    rows += [(int(300 + k), rows[0][1]) for k in range(30)] + [(400, [2 * v for v in rows[0][1]])]
    odd = [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0, None]), (504, [float("inf")] * 16), (505, []), (None, rows[0][1])]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = x @ x.T >= embedding_dedup.COSINE
    np.fill_diagonal(near, False)
    comp = smallest_reachable(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near))])
    schema = "vec_id long, embedding array<float>, label int, id string, size string"
    docs = spark.createDataFrame([(i, v, None, "x", "y") for i, v in rows + odd], schema)
    out = {r.vec_id: r for r in embedding_dedup.near_duplicates(docs).collect()}
    assert len(out) == len(rows) + len(odd)
    found = sum(out[i].n_links for i in ids.tolist())
    assert 0.9 * near.sum() <= found <= near.sum()
    assert all(out[i].n_links <= n for i, n in zip(ids.tolist(), near.sum(1)))
    assert np.mean([out[i].component_id == comp[i] for i in ids.tolist()]) > 0.95
    assert all(out[i].kept == (out[i].component_id == i) for i in ids.tolist())
    assert all((out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True) for i, _ in odd)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_chunks_of_a_hot_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 8)
    docs = spark.createDataFrame([(i, [1.0, i / 1e5, 0.0]) for i in range(60)], "vec_id long, embedding array<double>")
    assert {(r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(docs).collect()} == {(59, 0)}


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        text = bytes(rng.randrange(rng.choice([1, 2, 4, 250])) for _ in range(rng.randrange(1, 90)))
        text = text[:9] * 40 if rng.random() < 0.2 else text
        order = suffix_arrays.suffix_array(np.frombuffer(text, np.uint8), 50)
        heads = [text[i:i + 50].ljust(50, b"\0") for i in order]
        assert heads == sorted(heads) and sorted(order) == list(range(len(text)))
        got = suffix_arrays.common_prefixes(np.frombuffer(text, np.uint8), order, 50)
        for k in range(1, len(order)):
            a, b = text[order[k]:], text[order[k - 1]:]
            same = next((m for m, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[k] == min(same, 50)


def brute_passages(rows):
    first, out = {}, {}
    rows = sorted((2**63 - 1 if i is None else i, k, t.encode()) for k, (i, t) in enumerate(rows))
    for i, k, raw in rows:
        covered = np.zeros(len(raw), bool)
        for s in range(len(raw) - 49):
            if first.setdefault(raw[s:s + 50], i) < i:
                covered[s:s + 50] = True
        spans = int((np.diff(np.r_[False, covered].astype(int)) == 1).sum())
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        out[k] = (None if i == 2**63 - 1 else i, len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_passages(spark, odd_docs, no_docs, sf_docs, texts, hot, monkeypatch):
    """With HOT = 1 the floor of 64 makes the passage that 100 documents share a hot one."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(20))
    made = [(i, f"{word()} {word()} {passage if i % 3 else 'ab ' * 40} {word()}") for i in range(150)]
    cases = [(spark.createDataFrame(made, "doc_id long, text string").repartition(4), made)]
    if hot > 1:
        cases += [(odd_docs, texts[0]), (sf_docs, texts[1])]
        assert suffix_dedup.removed_passages(no_docs).count() == 0
    else:
        monkeypatch.setattr(suffix_dedup, "HOT", 10**9)
    for docs, rows in cases:
        got = sorted((tuple(r) for r in suffix_dedup.removed_passages(docs).collect()), key=str)
        assert got == brute_passages(rows)


def test_long_texts_are_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghij") for _ in range(900))
    rows = [(1, text), (2, text[100:400] + "#" + text[350:]), (3, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in suffix_dedup.removed_passages(docs).collect()), key=str) == brute_passages(rows)
