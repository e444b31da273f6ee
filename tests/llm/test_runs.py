"""Periodic runs against the definition."""

import hashlib
import random
import re
import zlib

import numpy as np

from broadsheet.llm import periodic_runs


def plain_runs(ws):
    n, out = len(ws), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                stretch = ws[i:i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, ws):
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    if doc_id is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return ws[:a] + [ws[a + (i - a) % p] for i in range(a, n)]


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def random_text(rng, n):
    out = []
    while len(out) < n:
        part = [rng.choice("abc") for _ in range(rng.randint(1, 14))]
        out += part * rng.choice([1, 1, 2, 4, 5, 9]) + part[: rng.randint(0, len(part))]
    return out


def test_runs_of_random_texts():
    rng = random.Random(7)
    texts = [random_text(rng, rng.randint(0, 250)) for _ in range(300)] + [["x"] * 500, ["x", "y"] * 300, [], ["x"] * 5, ["x"] * 6]
    texts += [[str(k % q) for k in range(4 * q + extra)] for q in range(1, 40) for extra in (-1, 0, 1)]
    found, collapsed = periodic_runs.read_batch([" ".join(t) for t in texts])
    for t, runs, rest in zip(texts, found, collapsed):
        assert [tuple(r.values()) for r in runs] == plain_runs(t)
        drop = {i for r in runs for i in range(r["start"] + r["period"], r["start"] + r["length"])}
        assert rest == " ".join(w for i, w in enumerate(t) if i not in drop)


def test_copies_do_not_match_across_documents():
    text = "a b a b a b a b a b c " * 3
    alone = periodic_runs.read_batch([text])
    assert periodic_runs.read_batch([text] * 50) == (alone[0] * 50, alone[1] * 50)


def test_range_successor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 64, 200):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        low = rng.integers(0, n + 1, 300)
        high = np.minimum(low + rng.integers(0, n + 1, 300), n)
        bound = rng.integers(0, n, 300)
        want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(low, high, bound)]
        assert tree.successor(low, high, bound).tolist() == want


def test_run_digests(odd_docs, sf_docs, no_docs, texts, spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rng = random.Random(9)
    mine = [(1000 + k, " ".join(random_text(rng, rng.randint(0, 120)))) for k in range(300)]
    frames = (odd_docs, sf_docs, spark.createDataFrame(mine, "doc_id long, text string"))
    planted_docs = 0
    for docs, rows in zip(frames, (*texts, mine)):
        want = []
        for i, t in rows:
            ws = planted(i, words(t))
            planted_docs += ws != words(t)
            # The long text of the odd rows has no run beyond the planted one.
            runs = plain_runs(ws) if len(ws) < 3000 else [tuple(r.values()) for r in periodic_runs.read_batch([" ".join(ws)])[0][0]]
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
            drop = {j for s, length, q in runs for j in range(s + q, s + length)}
            want.append((i, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
                         sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for j, w in enumerate(ws) if j not in drop))))
        got = [tuple(r) for r in periodic_runs.run_digests(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert planted_docs > 20
    assert periodic_runs.run_digests(no_docs).count() == 0
