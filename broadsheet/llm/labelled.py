"""Bounded samples of labelled documents for fitting the classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text

#: Characters per label after which a sample takes no further document. The document that passes the bound is still taken whole.
SAMPLE_CHARS = 32_000_000


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, per_class: int) -> pd.DataFrame:
    """(text, label) of at most ``per_class`` documents per label outside the held-out part, and of about ``SAMPLE_CHARS``.

    Documents are taken whole, whatever their length, in the order of the hash of their id,
    so every run fits the same model. The ids are at most 2 * per_class; they are
    broadcast to one scan for the lengths and to one for the texts that are taken.
    """
    usable = labels.where(F.col(label).isin(0, 1) & (remainder("doc_id", parts) != held)).select(
        F.col("doc_id").alias("labelled"), F.col(label).cast("int").alias("label")
    )
    order = F.xxhash64("labelled")
    ids = usable.where("label = 1").orderBy(order).limit(per_class).unionByName(
        usable.where("label = 0").orderBy(order).limit(per_class)
    ).withColumn("turn", order)
    found = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("labelled"))
    sizes = found.select("doc_id", "label", "turn", F.length("text").alias("size")).toPandas().sort_values(["label", "turn", "size"])
    before = sizes.groupby("label")["size"].cumsum() - sizes["size"]
    # Rows that repeat an id come or go together.
    late = set(zip(sizes["doc_id"][before >= SAMPLE_CHARS], sizes["label"][before >= SAMPLE_CHARS]))
    if late:
        spark = docs.sparkSession
        gone = spark.createDataFrame([(int(i), int(k)) for i, k in late], "labelled long, label int")
        found = found.join(F.broadcast(gone), ["labelled", "label"], "left_anti")
    fit = found.select("doc_id", "text", "label").toPandas()
    return fit.sort_values(["doc_id", "label", "text"])[["text", "label"]].reset_index(drop=True)
