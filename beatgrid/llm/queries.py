"""The registered queries of this package and their SQL."""

from pyspark.sql import DataFrame, SparkSession

from beatgrid.llm import (
    adaptive_ann,
    decontaminate,
    langid_nb,
    merkle_manifest,
    mixing,
    oracles,
    product_codes,
    quality_gbt,
    secret_scan,
    sharding,
    simhash_bk,
    suffix_merge,
    template_html,
    token_histogram,
)
from beatgrid.llm.common import narrow, table


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return narrow(table(spark, sf_dir, "documents"), *columns)


QUERIES = {
    "op1_adaptive_neighbours": lambda s, d: adaptive_ann.op1_adaptive_neighbours(table(s, d, "embeddings")),
    "op2_token_histogram": lambda s, d: token_histogram.op2_token_histogram(_docs(s, d, "text")),
    "op3_site_text": lambda s, d: template_html.op3_site_text(table(s, d, "pages")),
    "op4_repeated_bytes": lambda s, d: suffix_merge.op4_repeated_bytes(_docs(s, d, "doc_id", "text")),
    "op5_benchmark_hits": lambda s, d: decontaminate.op5_benchmark_hits(_docs(s, d, "doc_id", "text"), table(s, d, "benchmark")),
    "op6_quality_scores": lambda s, d: quality_gbt.op6_quality_scores(_docs(s, d, "doc_id", "text"), table(s, d, "labels")),
    "op7_source_mix": lambda s, d: mixing.op7_source_mix(_docs(s, d, "doc_id", "text", "source")),
    "op8_rendezvous_shards": lambda s, d: sharding.op8_rendezvous_shards(_docs(s, d, "doc_id", "text")),
    "op9_languages": lambda s, d: langid_nb.op9_languages(_docs(s, d, "doc_id", "text", "lang")),
    "op10_simhash_groups": lambda s, d: simhash_bk.op10_simhash_groups(_docs(s, d, "doc_id", "text")),
    "op11_secret_spans": lambda s, d: secret_scan.op11_secret_spans(_docs(s, d, "doc_id", "text")),
    "op12_merkle_proofs": lambda s, d: merkle_manifest.op12_merkle_proofs(table(s, d, "documents")),
    "op13_vector_codes": lambda s, d: product_codes.op13_vector_codes(table(s, d, "embeddings")),
}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline
ORACLES = oracles.ORACLES
