"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

import textwrap

from . import (
    centroids, copies, divergence, extraction, mixing, near, packing, pieces, private, quality, rules, tokens, urls,
)
from .common import table


def op1_quality_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return copies.exact_groups(table(spark, sf_dir, "documents"))


def op4_html_text(spark, sf_dir):
    return extraction.extract_main_text(table(spark, sf_dir, "pages"))


def op5_sentencepiece(spark, sf_dir):
    return pieces.encode_decode(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark, sf_dir):
    return near.near_groups(table(spark, sf_dir, "documents")).drop("digest")


def op8_private_data(spark, sf_dir):
    return private.find_private(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op10_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op11_centroid_clusters(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_token_counts, op3_exact_dedup, op4_html_text, op5_sentencepiece,
        op6_mix_sources, op7_near_dedup, op8_private_data, op9_quality_classifier, op10_url_filter,
        op11_centroid_clusters, op12_source_divergence, op13_best_fit_packing,
    )
}
ORACLES = {
    name: textwrap.dedent(sql).strip()
    for name, sql in (
        ("op1_quality_rules", rules.oracle_sql()),
        ("op3_exact_dedup", copies.ORACLE_SQL),
        ("op6_mix_sources", mixing.oracle_sql()),
        ("op10_url_filter", urls.oracle_sql()),
        ("op11_centroid_clusters", centroids.oracle_sql()),
        ("op12_source_divergence", divergence.ORACLE_SQL),
    )
}
