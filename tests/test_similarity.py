import random
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.config import SimilarityConfig
from broadsheet.operators.components import clusters
from broadsheet.operators.similarity import lsh_links, piece_postings, shingle_sets, similar_links


def grams(text, width=3):
    ws = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)}


def brute_clusters(rows, num=8, den=10):
    sets = {(s, i): grams(t) for s, i, t in rows}
    texts = {(s, i): re.sub(r"\s+", " ", t.lower()).strip() for s, i, t in rows}
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for x, a in enumerate(keys):
        for b in keys[x + 1:]:
            if a[0] != b[0]:
                continue
            shared = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            if texts[a] == texts[b] or (union and shared * den >= union * num):
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    groups = {k: find(k) for k in keys}
    sizes = {}
    for g in groups.values():
        sizes[g] = sizes.get(g, 0) + 1
    return {k: g[1] for k, g in groups.items() if sizes[g] > 1}


def crowd(seed):
    """Copies, near copies of templates, just-too-different ones, short and lone texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(scope, words):
        rows.append((scope, len(rows), " ".join(words)))

    for t in range(4):
        template = [rng.choice(vocabulary) for _ in range(rng.choice([12, 20, 40, 60]))]
        for _ in range(40):
            words = list(template)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            add("s%d" % rng.choice([1, 1, 1, 2]), words[: len(words) - rng.choice([0, 0, 0, 2])])
    for _ in range(40):
        add("s1", [rng.choice(vocabulary) for _ in range(rng.randrange(1, 50))])
    for _ in range(5):
        add("s1", ["two", "words"])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [2, 10, 1000])
def test_clusters_match_brute_force(spark, seed, limit):
    """Short and long postings, leaders and leftovers all give the exact components."""
    rows = crowd(seed)
    config = SimilarityConfig(posting_limit=limit, leader_rounds=2)
    sets = shingle_sets(spark.createDataFrame(rows, "scope string, id long, text string"), config)
    links = similar_links(sets, config)
    got = {(r.scope, r.id): r.cluster_id for r in clusters(links).collect()}
    assert got == brute_clusters(rows)


def test_copies_cost_one_link_each(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        words = list(base)
        words[i % 60] = f"x{i}"
        rows.append(("s", i, " ".join(words)))
    config = SimilarityConfig(posting_limit=20)
    links = similar_links(shingle_sets(spark.createDataFrame(rows, "scope string, id long, text string"), config), config)
    n = links.count()
    assert n < 3 * len(rows)
    found = clusters(links)
    assert found.count() == 600 and found.select("cluster_id").distinct().count() == 1


def test_lsh_links_are_true_links(spark):
    rows = crowd(3)
    df = spark.createDataFrame(rows, "scope string, id long, text string")
    want = brute_clusters(rows)
    found = lsh_links(df).collect()
    sets = {(s, i): grams(t) for s, i, t in rows}
    for r in found:
        a, b = sets[(r.scope, r.a)], sets[(r.scope, r.b)]
        assert r.shared == len(a & b) and r.shared * 10 >= len(a | b) * 8
    linked = {(r.scope, x) for r in found for x in (r.a, r.b)}
    with_grams = {k for k in want if sets[k]}
    assert len(linked & with_grams) >= 0.8 * len(with_grams)


def test_components_of_chains_and_hubs(spark):
    chain = [("c", i, i + 1) for i in range(100, 160)]
    hub = [("h", 500, i) for i in range(501, 900)]
    other = [("c", 1, 2), ("c", 5, 4), ("c", 4, 3)]
    links = spark.createDataFrame(chain + hub + other, "scope string, a long, b long")
    got = {(r.scope, r.id): r.cluster_id for r in clusters(links).collect()}
    want = {("c", i): 100 for i in range(100, 161)} | {("h", i): 500 for i in range(500, 900)}
    want |= {("c", 1): 1, ("c", 2): 1, ("c", 3): 3, ("c", 4): 3, ("c", 5): 3}
    assert got == want


def near_texts(seed, n_templates=60):
    """Texts of 5 to 600 words and copies with just over and just under the changes that the threshold allows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(n_templates):
        template = [rng.choice(vocabulary) for _ in range(rng.choice([5, 9, 20, 32, 33, 34, 39, 40, 41, 63, 64, 66, 79, 82, 127, 130, 300, 600]))]
        if rng.random() < 0.3:
            template += passage
        rows.append(template)
        for _ in range(3):
            words, share = list(template), rng.choice([0.02, 0.03, 0.035, 0.04, 0.05])
            for at in rng.sample(range(len(words)), max(1, round(len(words) * share))):
                words[at] = f"x{rng.randrange(10**6)}"
            cut = rng.choice([0, 0, len(words) // 12, len(words) // 8, len(words) // 6])
            rows.append(words[cut:])
    return [("s", i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("limit", [2, 100])
def test_pieces_lose_no_pair(spark, limit):
    """Pairs on both sides of the threshold and of every change of level."""
    rows = near_texts(5)
    config = SimilarityConfig(posting_limit=limit)
    sets = shingle_sets(spark.createDataFrame(rows, "scope string, id long, text string"), config)
    got = {(r.scope, r.id): r.cluster_id for r in clusters(similar_links(sets, config)).collect()}
    want = brute_clusters(rows)
    assert len(want) > 60 and got == want


def test_shared_passages_are_no_candidates(spark):
    """Long texts that share a frequent passage meet nobody in the search for near copies."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(40)]
    rows = [("s", i, " ".join([f"w{rng.randrange(10**6)}" for _ in range(160)] + passage)) for i in range(300)]
    sets = shingle_sets(spark.createDataFrame(rows, "scope string, id long, text string"))
    assert piece_postings(sets, SimilarityConfig()).isEmpty()
    assert similar_links(sets).isEmpty()
