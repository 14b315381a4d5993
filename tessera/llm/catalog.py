"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import html_extraction, license_scan, merkle, mixing, quality_rules, sentence_pieces, simhash, token_alignment, token_counts, toxicity, url_filter, vector_dedup, warc
from tessera.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _shipped(q)
    for q in (
        license_scan.op1_license_scan,
        mixing.op2_mix_sources,
        token_counts.op3_token_counts,
        toxicity.op4_toxicity,
        quality_rules.op5_quality_rules,
        warc.op6_warc_derivatives,
        simhash.op7_simhash_near_dedup,
        sentence_pieces.op8_sentence_pieces,
        html_extraction.op9_html_extraction,
        vector_dedup.op10_embedding_near_dedup,
        token_alignment.op11_token_alignment,
        merkle.op12_merkle_manifest,
        url_filter.op13_url_filter,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_scan.SQL,
    "op2_mix_sources": mixing.SQL,
    "op5_quality_rules": quality_rules.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
