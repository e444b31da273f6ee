"""Exact and near-duplicate links between stories, linear in the data's copies.

A *link* says that two stories of one scope have Jaccard similarity of at least
``num/den`` over their word shingles. The links found have the same connected
components as the graph of all such pairs, but a crowd of n near copies yields
about n links and not n*n/2: identical shingle sets collapse first, and shingles
shared by a crowd are resolved through leaders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import SimilarityConfig
from ..functions.bind import bind
from ..functions.text import fingerprint
from ..session import materialise
from .components import clusters
from .skew import among, join_skewed, without

SET_KEY = ("scope", "signature")
STORY = ("scope", "id")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column, width: int) -> Column:
    """Sorted distinct 64-bit hashes of all ``width``-word runs of the whole text."""

    def runs(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - width)
        gram = F.transform(
            starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)])
        )
        return F.when(F.size(ws) >= width, F.array_sort(F.array_distinct(gram))).otherwise(
            F.array().cast("array<bigint>")
        )

    return bind(words(text), runs)


def exact_groups(stories: DataFrame, text: Column, scope: str = "scope", key: str = "id") -> DataFrame:
    """Groups of stories with equal normalised text; partial counts before the shuffle."""
    return (
        stories.groupBy(F.col(scope), fingerprint(text).alias("fingerprint"))
        .agg(F.min(key).alias("first_id"), F.count("*").alias("n_stories"))
        .where("n_stories > 1")
    )


def shingle_sets(stories: DataFrame, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """(scope, id, fingerprint, grams, n, signature) of (scope, id, text), written once.

    ``signature`` is equal exactly for equal shingle sets; a story too short for
    a shingle is identified by its normalised text instead.
    """
    marked = stories.select(
        "scope", "id", F.unhex(fingerprint(F.col("text"))).alias("fingerprint"), shingles(F.col("text"), config.width).alias("grams")
    )
    told = F.when(F.col("n") > 0, F.array_join(F.col("grams").cast("array<string>"), ",")).otherwise(
        F.concat(F.lit("short "), F.hex("fingerprint")))
    sets = marked.withColumn("n", F.size("grams").cast("long")).withColumn("signature", F.unhex(F.sha2(told, 256)))
    return materialise(sets, "shingles")


def described(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` (scope, id, cluster_id) with the fingerprints of their texts."""
    members = materialise(members, "clustered")
    prints = among(sets.select(*STORY, "fingerprint"), members, STORY)
    return members.join(prints, list(STORY))


def _close(shared: Column, na: Column, nb: Column, config: SimilarityConfig) -> Column:
    return shared * config.den >= (na + nb - shared) * config.num


def measured(pairs: DataFrame, sets: DataFrame, hub: bool = False) -> DataFrame:
    """Add exact ``shared``, ``na``, ``nb`` to (scope, a, b); with ``hub`` one ``a`` may have many rows."""
    left = sets.select("scope", F.col("id").alias("a"), F.col("grams").alias("_ga"), F.col("n").alias("na"))
    right = sets.select("scope", F.col("id").alias("b"), F.col("grams").alias("_gb"), F.col("n").alias("nb"))
    with_b = pairs.join(right, ["scope", "b"])
    both = join_skewed(with_b, left, ["scope", "a"]) if hub else with_b.join(left, ["scope", "a"])
    shared = F.size(F.array_intersect("_ga", "_gb")).cast("long")
    return both.select("scope", "a", "b", shared.alias("shared"), "na", "nb")


def prefix_postings(sets: DataFrame, total: int, config: SimilarityConfig) -> DataFrame:
    """(scope, gram, id, n, rare, short_side): the rarest grams of each story.

    With threshold t, a story of n grams and an equal or longer partner at or
    above t share one of the first ``n - ceil(2t/(1+t) * n) + 1`` grams of the
    story (``short_side``), which is also among the first ``n - ceil(t*n) + 1``
    grams of the partner. Any fixed order of grams is correct; frequent grams go
    last so that postings stay short. Only grams above ``total / 100_000``
    occurrences need an exact rank, and there are fewer than 100 000 of those,
    which bounds the broadcast. ``total`` is the number of grams of all stories;
    ``rare`` counts the grams of a story that are not frequent.
    """
    postings = sets.select("scope", "id", F.explode("grams").alias("gram"))
    common = (
        postings.groupBy("gram")
        .agg(F.count("*").alias("_df"))
        .where(F.col("_df") > max(4, total // 100_000))
    )
    frequent = (
        postings.join(F.broadcast(common), "gram")
        .groupBy("scope", "id")
        .agg(F.array_sort(F.collect_list(F.struct("_df", "gram")))["gram"].alias("_frequent"))
    )
    n = F.col("n")
    take = n - F.ceil(n * config.num / config.den).cast("long") + 1
    take_short = n - F.ceil(n * (2 * config.num) / (config.num + config.den)).cast("long") + 1
    last = F.coalesce("_frequent", F.array().cast("array<bigint>"))
    ranked = F.concat(F.array_except("grams", last), last)
    return (
        sets.select("scope", "id", "n", "grams")
        .join(frequent, list(STORY), "left")
        .select(
            "scope", "id", "n", (n - F.size(last)).alias("rare"),
            F.posexplode(F.slice(ranked, F.lit(1), take.cast("int"))).alias("_rank", "gram"),
        )
        .select("scope", "gram", "id", "n", "rare", (F.col("_rank") < take_short).alias("short_side"))
    )


#: Sets below this size are searched by single grams; larger ones are cut into pieces.
PIECES_FROM = 32


def _pieces(grams: Column, size: Column, level: Column, parts: Column) -> Column:
    """Hashes of the grams that lie in each of ``parts`` equal ranges of all hashes, empty ranges left out; ``grams`` are sorted."""

    def cut(ranges: Column) -> Column:
        steps = F.sequence(F.lit(0), size.cast("int") - 1)
        starts = F.filter(steps, lambda i: F.coalesce(F.get(ranges, i) != F.get(ranges, i - 1), F.lit(True)))
        return bind(starts, lambda at: F.transform(
            at, lambda s, j: F.xxhash64(level, F.slice(grams, s + 1, F.coalesce(F.get(at, j + 1), size.cast("int")) - s))))

    return bind(_ranges(grams, parts), cut)


def _ranges(grams: Column, parts: Column) -> Column:
    """The range of each gram, from 0."""
    return bind(parts, lambda k: F.transform(
        grams, lambda g: F.least(F.floor((g.cast("double") / 2.0**64 + 0.5) * k).cast("int"), k.cast("int") - 1)))


def _level(n: Column) -> Column:
    return (F.length(F.bin(n)) - 1).cast("long")


def _differ(total: Column, config: SimilarityConfig) -> Column:
    return F.floor(total * (config.den - config.num) / (config.den + config.num))


def _need(n: Column, lower: Column, config: SimilarityConfig) -> Column:
    """How many of its pieces a set of ``n`` grams gives at most, cut for its own level or for the one below; see :func:`_cuts`."""
    first = F.pow(F.lit(2.0), _level(n)).cast("long")
    by_gram = F.when(lower, F.floor(first / 2)).otherwise(n) < PIECES_FROM
    partner = F.when(lower, first - 1).otherwise(F.floor(n * config.den / config.num))
    return F.when(by_gram, n - F.ceil(n * config.num / config.den) + 1).otherwise(_differ(n + partner, config) + 1)


def _cuts(config: SimilarityConfig) -> Column:
    """What a set of (grams, n) gives to the search: ``array<struct<filled, pieces, blanks>>``, once or twice.

    Sizes of 2^e to 2^(e+1) - 1 are level e, cut into one number of ranges. Two sets at the threshold of sizes n and m differ
    in at most (n + m) * (1 - t) / (1 + t) grams, and a gram that differs spoils one range, so in any fixed order of the ranges'
    contents they have one in common among the first ``need``, that number and one more, of each. A set that
    may have a partner one level below is cut for that level too. Where fewer ranges are filled than needed, the empty ones
    count as well. Sets below ``PIECES_FROM`` and their partners are searched by grams.
    """
    n, num, den = F.col("n"), config.num, config.den
    own = _level(n)
    start = F.pow(F.lit(2.0), own).cast("long")
    plain = F.struct(n.alias("filled"), F.col("grams").alias("pieces"), F.array().cast("array<bigint>").alias("blanks"))

    def cut(level: Column, first: Column, need: Column) -> Column:
        last = 2 * first - 1
        parts = F.floor(_differ(last + F.floor(last * den / num), config) * 1.25) + 4

        def counted(pieces: Column) -> Column:
            missing = F.array_except(F.sequence(F.lit(0), parts.cast("int") - 1), _ranges(F.col("grams"), parts))
            blanks = F.when(F.size(pieces) < need, F.transform(missing, lambda i: F.xxhash64(level, i, F.lit("blank"))))
            return F.struct(
                F.size(pieces).cast("long").alias("filled"), pieces.alias("pieces"),
                F.coalesce(blanks, F.array().cast("array<bigint>")).alias("blanks"))

        return bind(_pieces(F.col("grams"), n, level, parts), counted)

    below = F.floor(start / 2)
    at_own = F.when(n < PIECES_FROM, plain).otherwise(cut(own, start, _need(n, F.lit(False), config)))
    at_lower = F.when(below < PIECES_FROM, plain).otherwise(cut(own - 1, below, _need(n, F.lit(True), config)))
    lower = F.when((n >= PIECES_FROM) & ((start - 1) * den >= n * num), at_lower)
    return F.filter(F.array(at_own, lower), lambda c: c.isNotNull())


def piece_postings(sets: DataFrame, config: SimilarityConfig) -> DataFrame:
    """(scope, gram, id, n, rare, short_side) as :func:`prefix_postings`, ``gram`` being a piece of several grams; see :func:`_cuts`.

    Pieces are ordered by the number of stories that have them, so that a story whose first pieces are its own is out
    of the search. ``rare`` counts the pieces that no other story has. Every piece of every set is moved once, so
    a row of it is kept short: ``about`` holds n from bit 32, the filled ranges from bit 2, the level and whether the range is empty.
    """
    cuts = sets.select("scope", "id", "n", F.posexplode(_cuts(config)).alias("lower", "c"))
    about = F.col("n") * (1 << 32) + F.col("filled") * 4 + F.col("lower") * 2
    rows = cuts.select(
        "scope", "id", "n", "lower", "c.filled", F.posexplode(F.concat("c.pieces", "c.blanks")).alias("_at", "piece"),
    ).select("piece", "id", (about + (F.col("_at") >= F.col("filled")).cast("int")).alias("about"), "scope")
    blank = F.col("about") % 2
    shared = rows.withColumn("df", F.count("*").over(Window.partitionBy("scope", "piece"))).where("df > 1")
    stories = shared.select("scope", "id", (F.col("about") - blank).alias("about"), blank.alias("blank"), "df", "piece").groupBy("scope", "id", "about").agg(
        F.array_sort(F.collect_list(F.struct("blank", "df", "piece")))["piece"].alias("pieces"), F.count_if(F.col("blank") == 0).alias("_shared"),
    ).select(
        "scope", "id", "pieces", "_shared", F.shiftright("about", 32).alias("n"), F.shiftright(F.col("about") % (1 << 32), 2).alias("filled"),
        (F.col("about") % 4 >= 2).alias("lower"))
    rare = F.col("filled") - F.col("_shared")
    take = _need(F.col("n"), F.col("lower"), config) - rare
    return stories.where(take > 0).select(
        "scope", "id", "n", rare.alias("rare"), F.lit(True).alias("short_side"),
        F.explode(F.slice("pieces", F.lit(1), take.cast("int"))).alias("gram"),
    ).select("scope", "gram", "id", "n", "rare", "short_side")


def _meets(small: Column, large: Column, config: SimilarityConfig) -> Column:
    """Whether a short-side row can be close to an equal or longer story."""
    longer = (small["n"] < large["n"]) | ((small["n"] == large["n"]) & (small["id"] < large["id"]))
    return small["short_side"] & longer & (large["n"] * config.num <= small["n"] * config.den)


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _cold_pairs(postings: DataFrame, cold: DataFrame, config: SimilarityConfig) -> DataFrame:
    """Candidates of postings no longer than ``posting_limit``; ``cold`` lists those grams.

    The join leaves the rows of a gram together, so collecting them, at most
    ``posting_limit`` by the choice of ``cold``, moves nothing.
    """
    row = F.struct("n", "id", "short_side")
    grouped = postings.join(cold, ["scope", "gram"]).groupBy("scope", "gram").agg(F.collect_list(row).alias("rows"))
    small = grouped.select("scope", "rows", F.explode(F.filter("rows", lambda r: r["short_side"])).alias("x"))
    met = small.select("scope", "x", F.explode(F.filter("rows", lambda r: _meets(F.col("x"), r, config))).alias("y"))
    return met.select("scope", *_ordered(F.col("x.id"), F.col("y.id"))).distinct()


def _leaders(open_rows: DataFrame, k: int) -> DataFrame:
    """``k`` stories per posting with the fewest grams of their own; each task keeps ``k``."""
    order = Window.partitionBy("scope", "gram").orderBy("rare", "id")
    return open_rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).select(
        "scope", "gram", F.col("id").alias("a"))


def _thinned(links: DataFrame) -> DataFrame:
    """One link per story ``b``, to its first leader ``a``, and one from each other leader to a story of that one; the components stay."""
    marked = links.withColumn("_first", F.min("a").over(Window.partitionBy("scope", "b")))
    bridges = marked.where("a <> _first").groupBy("scope", "_first", "a").agg(F.min("b").alias("b"))
    return marked.where("a = _first").select("scope", "a", "b").unionByName(bridges.select("scope", "a", "b"))


def _leader_links(crowd: DataFrame, sets: DataFrame, config: SimilarityConfig) -> tuple[DataFrame, DataFrame]:
    """(links to leaders, distance of every row to its posting's first leader).

    A leader is a likely original of a crowd of copies: a story with few grams of
    its own. It is compared with every row of its posting. Stories that found no
    leader supply the next round's.
    """
    links = gaps = None
    open_rows = crowd
    for number in range(config.leader_rounds):
        leaders = materialise(_leaders(open_rows, 1 if number == 0 else config.leaders), "leaders")
        seated = join_skewed(crowd, leaders, ["scope", "gram"])
        asked = seated.select("scope", "a", F.col("id").alias("b")).where("a <> b").distinct()
        known = materialise(measured(asked, sets, hub=True), "compared")
        near = known.where(_close(F.col("shared"), F.col("na"), F.col("nb"), config))
        found = near.select("scope", "a", "b")
        links = found if links is None else links.unionByName(found)
        if gaps is None:
            gap = 1.0 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
            gaps = seated.join(known.select("scope", "a", F.col("b").alias("id"), gap.alias("gap")), ["scope", "a", "id"], "left")
        settled = near.select("scope", F.col("b").alias("id")).unionByName(leaders.select("scope", F.col("a").alias("id")))
        open_rows = materialise(open_rows.join(settled.distinct(), list(STORY), "left_anti"), "open")
        largest = open_rows.groupBy("scope", "gram").count().agg(F.max("count")).first()[0] or 0
        if largest <= config.posting_limit:
            break
    told = _thinned(links).select("scope", *_ordered(F.col("a"), F.col("b"))).distinct()
    return told, gaps.withColumn("gap", F.coalesce("gap", F.lit(0.0))).drop("a")


def _hot_links(crowd: DataFrame, known: DataFrame, sets: DataFrame, config: SimilarityConfig) -> DataFrame:
    """Links among crowds that share a gram, without listing the crowd's pairs.

    Leaders link a crowd in linear time. Pairs whose stories ``known`` links or
    leaders already connect need no link, so in each posting only rows outside
    its largest component are compared with the others. Jaccard distance is a
    metric: two stories whose distances to one leader differ by more than 1 - t
    cannot be close and are not measured. No candidate is left out.
    """
    spread = 32
    reach = 1.0 - config.num / config.den + 1e-9
    crowd = materialise(crowd, "crowd")
    direct, gaps = _leader_links(crowd, sets, config)
    direct = materialise(direct, "direct")
    members = clusters(known.unionByName(direct))
    rows = materialise(
        gaps.join(members, list(STORY), "left").withColumn("part", F.coalesce("cluster_id", "id")).drop("cluster_id"), "rows"
    )
    largest = (
        rows.groupBy("scope", "gram", "part").agg(F.count("*").alias("_n"))
        .groupBy("scope", "gram").agg(F.max_by("part", "_n").alias("part"))
    )
    outside = rows.join(largest, ["scope", "gram", "part"], "left_anti")
    row = F.struct("n", "id", "short_side", "gap", "part")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    x = outside.select("scope", "gram", row.alias("x"), copies.alias("_salt"))
    y = rows.select("scope", "gram", row.alias("y"), F.pmod(F.xxhash64("id"), F.lit(spread)).alias("_salt"))
    met = (
        x.join(y, ["scope", "gram", "_salt"])
        .where((F.col("x.part") != F.col("y.part")) & (F.abs(F.col("x.gap") - F.col("y.gap")) <= reach))
        .where(_meets(F.col("x"), F.col("y"), config) | _meets(F.col("y"), F.col("x"), config))
        .select("scope", *_ordered(F.col("x.id"), F.col("y.id")))
        .distinct()
    )
    rest = measured(met, sets).where(_close(F.col("shared"), F.col("na"), F.col("nb"), config))
    return direct.unionByName(rest.select("scope", "a", "b"))


def similar_links(sets: DataFrame, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """(scope, a, b) links with a < b over the output of :func:`shingle_sets`.

    Equal texts and equal shingle sets are linked to their first story; only that
    one takes part in the search for near copies.
    """
    rows, total = sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    repeated = materialise(
        sets.groupBy(*SET_KEY)
        .agg(F.min("id").alias("a"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n"),
        "repeated",
    )
    copies = materialise(
        join_skewed(among(sets.select(*SET_KEY, F.col("id").alias("b")), repeated, SET_KEY), repeated, SET_KEY, rows)
        .where("a < b")
        .select("scope", "a", "b"),
        "copies",
    )
    firsts = without(sets.where("n > 0"), copies.select("scope", F.col("b").alias("id")), STORY)
    # Below 0.7 pieces would hold a single gram or none.
    apart = config.num * 10 >= config.den * 7
    postings = materialise(piece_postings(firsts, config) if apart else prefix_postings(firsts, total, config), "postings")
    sizes = materialise(
        postings.groupBy("scope", "gram")
        .agg(F.count("*").alias("_n"), F.count_if("short_side").alias("_short"))
        .where("_n > 1 AND _short > 0"),
        "sizes",
    )
    cold = sizes.where(F.col("_n") <= config.posting_limit).select("scope", "gram")
    hot = sizes.where(F.col("_n") > config.posting_limit).select("scope", "gram")
    # Only sets of stories that meet another one are moved from here on.
    meeting = materialise(postings.join(sizes, ["scope", "gram"], "left_semi").select(*STORY).distinct(), "meeting")
    sets = materialise(among(sets.select(*STORY, "grams", "n"), meeting, STORY), "meeting-sets")
    met = measured(_cold_pairs(postings, cold, config), sets)
    links = _thinned(met.where(_close(F.col("shared"), F.col("na"), F.col("nb"), config)).select("scope", "a", "b"))
    if not hot.isEmpty():
        links = materialise(links, "cold-links")
        links = links.unionByName(_hot_links(postings.join(hot, ["scope", "gram"]), links, sets, config))
    return materialise(copies.unionByName(links).distinct(), "links")


# Fixed universal-hash family over the Mersenne prime 2**31 - 1.
_PRIME = 2_147_483_647


def _hash_pair(i: int) -> tuple[int, int]:
    return (1_103_515_245 * (i + 1) + 12_345) % _PRIME, (69_069 * (i + 7) + 1) % _PRIME


def lsh_links(
    stories: DataFrame, bands: int = 4, rows: int = 4, config: SimilarityConfig = SimilarityConfig()
) -> DataFrame:
    """Approximate links through banded min-hash signatures.

    Every story is compared with the first story of each of its band buckets and
    linked if the exact similarity reaches the threshold. Buckets are never cut
    or dropped, and each costs one comparison per member.
    """
    def gram_texts(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - config.width)
        gram = F.transform(starts, lambda i: F.array_join(F.slice(ws, i + 1, config.width), " "))
        return F.when(F.size(ws) >= config.width, F.array_distinct(gram)).otherwise(F.array().cast("array<string>"))

    def hashed(texts: Column) -> Column:
        value = F.transform(texts, lambda g: F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % _PRIME)
        return F.struct(bind(value, banded).alias("buckets"), F.transform(texts, lambda g: F.xxhash64(g)).alias("grams"))

    def banded(hashes: Column) -> Column:
        def least(i: int) -> Column:
            a, b = (F.lit(x).cast("long") for x in _hash_pair(i))
            return F.array_min(F.transform(hashes, lambda h: (h * a + b) % _PRIME)).cast("string")

        return F.array(*[F.concat_ws("-", *[least(band * rows + r) for r in range(rows)]) for band in range(bands)])

    both = stories.select("scope", "id", bind(bind(words(F.col("text")), gram_texts), hashed).alias("_b"))
    base = materialise(
        both.select("scope", "id", F.col("_b.buckets").alias("buckets"), F.col("_b.grams").alias("grams"), F.size("_b.grams").cast("long").alias("n")),
        "minhash",
    ).where("n > 0")
    buckets = materialise(base.select("scope", "id", F.posexplode("buckets").alias("band", "bucket")), "buckets")
    first = buckets.groupBy("scope", "band", "bucket").agg(F.min("id").alias("a"))
    met = (
        join_skewed(buckets.withColumnRenamed("id", "b"), first, ["scope", "band", "bucket"])
        .where("a < b").select("scope", "a", "b").distinct()
    )
    met = materialise(met, "met")
    # Only sets of stories that meet another one are moved.
    meeting = materialise(met.select("scope", F.col("a").alias("id")).unionByName(met.select("scope", F.col("b").alias("id"))).distinct(), "meeting")
    sets = materialise(among(base.select(*STORY, "grams", "n"), meeting, STORY), "meeting-sets")
    found = measured(met, sets, hub=True)
    return found.where(_close(F.col("shared"), F.col("na"), F.col("nb"), config))
