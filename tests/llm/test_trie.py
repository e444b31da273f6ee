"""The prefix trie against a plain trie over whole sequences."""

import hashlib
import random
import zlib
from collections import defaultdict

from broadsheet.llm import conv_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, name string, cut string, n long"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in own.items():
        name = lambda t: hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()
        own[c] = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], t[2], name(t)))]
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        todo, found = [p], []
        while todo:
            q = todo.pop()
            found.append(q)
            todo += children[q]
        return found

    out = []
    for p, m in members.items():
        tree = below(p)
        ends = sorted(c for c in m if len(whole[c]) == len(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in tree),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in tree if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def found(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", "y", None, 1) for r in rows], SCHEMA).repartition(parts)
    return [tuple(r) for r in conv_trie.prefix_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


def same(a, b):
    return sorted(a, key=str) == sorted(b, key=str)


def test_against_a_plain_trie(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "IDS_PER_STRING", 2)
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 13])):
            rows.append((c, t, rng.choice(["user", "bot"]) if t > 1 else "user", rng.choice(["a", "é b", ""]) if t > 2 else "hi"))
    rows += [(200, t, "user", f"{t % 3}") for t in range(40)]  # one long conversation
    rows += [(c, 1, "user", "only") for c in range(300, 330)]  # copies; those with a head and no base have no turns
    rows += [(400, None, None, None), (400, None, "user", None), (400, 1, "a", "same"), (400, 1, "a", "same"), (400, 1, "b", "x")]
    rows += [(None, 1, "user", "nobody"), (-7, 1, "user", "hi"), (-5, 1, "user", "hi")]
    assert same(found(spark, rows), brute(rows))


def test_single_and_empty(spark):
    one = [(5, 3, "user", "hello")]
    assert same(found(spark, one), brute(one))
    assert found(spark, one[:0]) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    turnless = [(c, 1, "user", "x") for c in range(1, 40) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    assert same(found(spark, turnless), brute(turnless)) and len(brute(turnless)) == 1
