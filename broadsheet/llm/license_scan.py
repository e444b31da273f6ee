"""License notices in documents by diagonal voting.

Every run of K words of a document is hashed and joined with the hashes of the
templates' runs. A hit at document word p and template word t votes for the
diagonal p - t; a notice that stands in the text word for word puts all its votes
on one diagonal, and inserted or lost words move the rest to a diagonal nearby.
Votes are counted by diagonal, neighbouring diagonals are merged, and a merged span
is verified by the share of the template's runs that it really holds (the words
themselves travel with each run and are compared, not just the hashes), by its length,
and by the runs that tell the template from its relatives: of the runs that no template of a related
licence has, a notice holds more than half, for each such licence. So a version or a
condition that differs in one word is not mistaken for its neighbour.

The templates are a fixed list, so their side of the join is small whatever the
input; documents are read once and only hits, and one row per document, are moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import PLAIN_WORD, lower_ascii, whole_text, words

K = 3
#: Diagonals this close to each other belong to one notice.
NEIGHBOUR = 4
#: A span is a notice when it holds this share of the template's runs,
COVERAGE = 0.6
#: and is at most this many times as long as the template.
STRETCH = 1.5

# Phrases whose places are counted, with their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Opening words of public licence notices, with their labels.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl-2", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    ("agpl-3", "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# Licences whose notices differ in few words.
FAMILIES = (("gpl-2", "gpl-3", "lgpl-2", "lgpl-3", "agpl-3"), ("cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc"))


def _runs(text: str) -> list[tuple[str, ...]]:
    w = text.split()
    return [tuple(w[t:t + K]) for t in range(len(w) - K + 1)]


def telling_runs(label: str, text: str) -> list[list[int]]:
    """Per licence of the label's family, the runs of ``text`` that none of that licence's notices has."""
    relatives = [other for family in FAMILIES if label in family for other in family if other != label]
    held = [{run for name, notice in NOTICES if name == other for run in _runs(notice)} for other in relatives]
    return [[t for t, run in enumerate(_runs(text)) if run not in theirs] for theirs in held]


def template_runs(spark: SparkSession) -> DataFrame:
    """(template, base, label, runs, t, a, b, c): one row per run of K words of a template."""
    rows = []
    for template, (label, text) in enumerate((*BASE, *NOTICES)):
        runs = _runs(text)
        rows += [(template, template < len(BASE), label, len(runs), t, *run) for t, run in enumerate(runs)]
    names = ("template", "base", "label", "runs", "t", "a", "b", "c")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return spark.range(1).select(F.inline(listed))


def _document_runs(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, n_words, p, a, b, c): the run that starts at each word; a document without words has one row."""
    split = docs.select(
        F.monotonically_increasing_id().alias("doc"), "doc_id", words(lower_ascii(whole_text()), PLAIN_WORD).alias("w")
    )
    n = F.size("w")
    shifted = F.arrays_zip(
        F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"),
        F.slice("w", F.lit(3), F.greatest(n - 2, F.lit(0))).alias("c"),
    )
    return split.select("doc", "doc_id", n.cast("long").alias("n_words"), F.posexplode_outer(shifted).alias("p", "run")).select(
        "doc", "doc_id", "n_words", "p", "run.a", "run.b", "run.c"
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """Documents -> (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row each.

    Base phrases count at every place where their words stand next to each other;
    overlapping places all count. ``labels`` adds the notices found by voting, and
    ``score`` is the best share of a template that the text holds (1 for a base
    phrase). ``spans`` lists what was found as (label, first word, last word,
    share). A null or empty text has no words and no label; null ids and repeated
    rows are documents of their own; other columns are not read.
    """
    runs = template_runs(docs.sparkSession).withColumn("h", F.xxhash64("a", "b", "c"))
    known = runs.select("h", "template", "base", "label", "runs", "t", *[F.col(x).alias("t_" + x) for x in "abc"])
    same = " AND ".join(f"{x} = t_{x}" for x in "abc")
    votes = (
        _document_runs(docs).withColumn("h", F.xxhash64("a", "b", "c")).join(F.broadcast(known), "h", "left")
        .withColumn("hit", F.coalesce(F.expr(same), F.lit(False)))
        .where("hit OR p IS NULL OR p = 0")
        .select("doc", "doc_id", "n_words", *[F.when(F.col("hit"), F.col(c)).alias(c) for c in ("template", "base", "label", "runs", "t", "p")])
    )
    key = ["doc", "doc_id", "n_words", "template", "base", "label", "runs"]
    diagonals = votes.groupBy(*key, (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("ts"), F.min("p").alias("first"), F.max("p").alias("last")
    )
    by_place = Window.partitionBy("doc", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(by_place) > NEIGHBOUR
    spans = diagonals.withColumn("span", F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(by_place)).groupBy(*key, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("ts"))).alias("held"),
        F.sum(F.when(F.size("ts") == F.col("runs"), 1).otherwise(0)).alias("whole"),
        F.min(F.when(F.size("ts") == F.col("runs"), F.col("first"))).alias("whole_first"),
        F.max(F.when(F.size("ts") == F.col("runs"), F.col("first"))).alias("whole_last"),
        F.min("first").alias("first"), (F.max("last") + (K - 1)).alias("last"),
    )
    share = F.size("held") / F.col("runs")
    base = F.coalesce("base", F.lit(False)) & (F.col("whole") > 0)
    told = F.lit(True)
    for template, (label, text) in enumerate(NOTICES, len(BASE)):
        for tells in telling_runs(label, text):
            enough = F.size(F.array_intersect("held", F.array(*map(F.lit, tells)))) * 2 > len(tells)
            told = told & ((F.col("template") != template) | enough)
    short = F.col("last") - F.col("first") + 1 <= STRETCH * (F.col("runs") + (K - 1))
    found = base | (~F.coalesce("base", F.lit(True)) & (share >= COVERAGE) & short & told)
    joined = lambda kept: F.array_join(F.array_sort(F.collect_set(F.when(kept, F.col("label")))), ",")
    return spans.groupBy("doc", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(base, F.col("whole"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.col("whole_first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("whole_last"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(found).alias("labels"),
        F.coalesce(F.max(F.when(base, F.lit(1.0)).otherwise(F.when(~F.col("base"), share))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, F.struct("first", "last", "label", share.alias("share"))))).alias("spans"),
    ).drop("doc")


def license_labels(docs: DataFrame) -> DataFrame:
    return license_scan(docs).drop("spans")


def sql() -> str:
    """The same result in SQL, for documents with different ids."""
    values = ", ".join(
        f"({template}, {template < len(BASE)}, '{label}', {len(text.split()) - K + 1}, '{text}')"
        for template, (label, text) in enumerate((*BASE, *NOTICES))
    )
    tells = ", ".join(
        f"({template}, {runs})" for template, (label, text) in enumerate(NOTICES, len(BASE)) for runs in telling_runs(label, text))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH templates(template, base, label, runs, phrase) AS (VALUES {values}),
runs AS (
  SELECT template, base, label, runs, unnest(range(runs)) AS t, string_split(phrase, ' ') AS w FROM templates
), known AS (
  SELECT template, base, label, runs, t, list_aggregate(w[t + 1 : t + {K}], 'string_agg', ' ') AS run FROM runs
), split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, unnest(range(len(w) - {K - 1})) AS p, w FROM split WHERE len(w) >= {K}
), votes AS (
  SELECT doc_id, p, k.* FROM places JOIN known k ON w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] = run
), diagonals AS (
  SELECT doc_id, template, base, label, runs, p - t AS diagonal, list(DISTINCT t) AS ts, min(p) AS first, max(p) + {K - 1} AS last
  FROM votes GROUP BY ALL
), marked AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER place > {NEIGHBOUR}, true) AS far
  FROM diagonals WINDOW place AS (PARTITION BY doc_id, template ORDER BY diagonal)
), numbered AS (
  SELECT *, sum(far::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked
), tells(template, telling) AS (VALUES {tells}), merged AS (
  SELECT doc_id, template, base, label, span, any_value(runs) AS runs, list_distinct(flatten(list(ts))) AS held, min(first) AS first, max(last) AS last,
         count(*) FILTER (len(ts) = runs) AS whole, min(first) FILTER (len(ts) = runs) AS whole_first,
         max(first) FILTER (len(ts) = runs) AS whole_last
  FROM numbered GROUP BY doc_id, template, base, label, span
), spans AS (
  SELECT *, len(held) / runs AS share, len(held) >= {COVERAGE} * runs AND last - first + 1 <= {STRETCH} * (runs + {K - 1}) AND NOT EXISTS (
    SELECT 1 FROM tells t WHERE t.template = m.template AND 2 * len(list_intersect(telling, held)) <= len(telling)) AS fits
  FROM merged m
), per AS (
  SELECT doc_id, sum(whole) FILTER (base) AS n_base, min(whole_first) FILTER (base) AS first_word,
         max(whole_last) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND whole > 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER ((base AND whole > 0) OR (NOT base AND fits)) AS labels,
         max(CASE WHEN base THEN CASE WHEN whole > 0 THEN 1.0 END ELSE share END) AS score
  FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM split LEFT JOIN per USING (doc_id)
"""
