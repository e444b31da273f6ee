"""Registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

from . import conv_trie, embedding_dedup, exact_dedup, license_scan, mil_quality, mixing, ngram_join, packing, periodic_runs, sentencepiece_bpe, suffix_dedup, toxicity, word_bpe
from .common import documents, table

QUERIES = {
    "op1_license_scan": lambda spark, sf_dir: license_scan.license_labels(documents(spark, sf_dir)),
    "op2_quality_mil": lambda spark, sf_dir: mil_quality.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels")),
    "op3_toxicity": lambda spark, sf_dir: toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels")),
    "op4_ngram_jaccard": lambda spark, sf_dir: ngram_join.components(documents(spark, sf_dir)),
    "op5_sentencepiece": lambda spark, sf_dir: sentencepiece_bpe.token_digests(documents(spark, sf_dir)),
    "op6_packing": lambda spark, sf_dir: packing.packed_rows(documents(spark, sf_dir)),
    "op7_embedding_dedup": lambda spark, sf_dir: embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")),
    "op8_suffix_dedup": lambda spark, sf_dir: suffix_dedup.removed_passages(documents(spark, sf_dir)),
    "op9_source_mixing": lambda spark, sf_dir: mixing.mixed_sizes(documents(spark, sf_dir)),
    "op10_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_dedup(documents(spark, sf_dir)),
    "op11_periodic_runs": lambda spark, sf_dir: periodic_runs.run_digests(documents(spark, sf_dir)),
    "op12_word_bpe": lambda spark, sf_dir: word_bpe.token_digests(documents(spark, sf_dir)),
    "op13_conv_trie": lambda spark, sf_dir: conv_trie.prefix_trie(table(spark, sf_dir, "conversations")),
}

ORACLES = {
    "op1_license_scan": license_scan.sql(),
    "op4_ngram_jaccard": ngram_join.SQL,
    "op8_suffix_dedup": suffix_dedup.SQL,
    "op9_source_mixing": mixing.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op13_conv_trie": conv_trie.SQL,
}
