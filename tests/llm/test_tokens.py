"""SentencePiece encoding against the library, packing as a round trip."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from broadsheet.llm import packing, sentencepiece_bpe


def test_random_texts_like_the_library():
    own = sentencepiece_bpe.Encoder(sentencepiece_bpe.MODEL)
    rng = random.Random(4)
    pieces = list(own.ids)
    texts = ["", " ", "▁▁ x", "\x00\n\n \n", "<s></s><unk><0x0A>", "a" * 500, " " * 300, "ther " * 200, "日本😀é" * 9]
    texts += ["".join(rng.choice("ab de.\n\t'=<>▁éß日01😀-_(){};\x00") for _ in range(rng.randint(1, 50))) for _ in range(3000)]
    texts += ["".join(rng.choice(pieces).replace("▁", " ") for _ in range(rng.randint(1, 10))) for _ in range(3000)]
    assert [own.encode(t) for t in texts] == own.library.encode(texts)
    assert all(own.merge(p) == [p] or own.compatible(own.ids[p], own.ids[p]) in (True, False) for p in pieces[:200])


def test_compatibility_is_remerging():
    own = sentencepiece_bpe.Encoder(sentencepiece_bpe.MODEL)
    rng, pieces = random.Random(5), list(own.ids)
    for a, b in ((rng.choice(pieces), rng.choice(pieces)) for _ in range(5000)):
        assert own.remerge(a, b) == (own.merge(a + b) == [a, b])


def test_small_tables_of_words_change_nothing(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "REMEMBERED", 3)
    own = sentencepiece_bpe.Encoder(sentencepiece_bpe.MODEL)
    text = "the quick brown fox jumps over the lazy dog and the quick brown cat"
    assert own.encode(text) == own.library.encode(text)


def test_token_digests(odd_docs, sf_docs, no_docs, texts):
    library = sentencepiece_bpe.encoder(sentencepiece_bpe.MODEL).library
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    order = lambda rows: sorted(rows, key=str)
    for docs, rows in zip((odd_docs, sf_docs), texts):
        want = []
        for i, t in rows:
            ids = library.encode(t)
            want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
        assert order(tuple(r) for r in sentencepiece_bpe.token_digests(docs).collect()) == order(want)
    assert sentencepiece_bpe.token_digests(no_docs).count() == 0


def test_cached_tokens_like_the_library(texts):
    own = packing.tokenizer(packing.RANKS)
    for _, t in texts[0] + texts[1]:
        assert own.encode(t).tolist() == own.library.encode_ordinary(t)


def test_best_fit_takes_the_fullest_row_that_fits():
    rng = np.random.default_rng(1)
    for capacity in (1, 7, 64, 100):
        sizes = rng.integers(1, capacity + 1, 300)
        row, offset = packing.best_fit(sizes, capacity)
        free: list[int] = []
        for k in np.argsort(-sizes, kind="stable"):
            fits = sorted((f, r) for r, f in enumerate(free) if f >= sizes[k])
            if fits:
                assert free[row[k]] == fits[0][0]
            else:
                assert row[k] == len(free)
                free.append(capacity)
            assert offset[k] == capacity - free[row[k]]
            free[row[k]] -= sizes[k]


def test_packing_round_trip(odd_docs, no_docs, texts):
    own = packing.tokenizer(packing.RANKS)
    capacity, back = 64, defaultdict(dict)
    packed = packing.pack(odd_docs, capacity).collect()
    for r in packed:
        ids, places = np.frombuffer(r.ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(ids) == len(places) == capacity and r.cu_seqlens[-1] <= capacity
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert places[a:b].tolist() == list(range(b - a))
            back[r.doc_ids[k]].setdefault(r.starts[k], []).append(ids[a:b].tolist())
    for i in {i for i, _ in texts[0]}:
        want = sorted([*own.encode(t).tolist(), packing.END] for j, t in texts[0] if j == i)
        if len(want) == 1:
            assert sum((back[i][s][0] for s in sorted(back[i])), []) == want[0]
        else:  # several rows share the id: all of them fit one segment here
            assert sorted(back[i][0]) == want
    assert packing.pack(no_docs).count() == 0
    assert sorted(map(str, packed)) == sorted(map(str, packing.pack(odd_docs.repartition(5), capacity).collect()))


def test_no_key_binds_its_rows_to_one_shard(spark, monkeypatch):
    """Null ids, one id with many texts, and one row many times: all are spread, and none is lost."""
    monkeypatch.setattr(packing, "SHARD_BYTES", 4096)
    rows = [(None, f"text {k}") for k in range(300)] + [(7, f"other {k}") for k in range(300)] + [(8, "the same row")] * 300 + [(None, None)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(docs.repartition(3), 64).collect()
    by_id = defaultdict(lambda: defaultdict(int))
    for r in packed:
        for i in r.doc_ids:
            by_id[i][r.shard] += 1
    assert {i: sum(n.values()) for i, n in by_id.items()} == {None: 600, 7: 300, 8: 300}
    assert len({r.shard for r in packed}) > 10
    assert all(max(n.values()) < sum(n.values()) / 5 for n in by_id.values())
    assert sorted(map(str, packed)) == sorted(map(str, packing.pack(docs.repartition(5), 64).collect()))
