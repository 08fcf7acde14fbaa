"""From raw documents to shards of a training mix.

Each stage takes all documents that its predecessor kept, and every stage but the
last returns the columns of documents. Between stages the documents are written to
the shared folder and read again, which also cuts the lineage.

Defined cases: an absent text counts as empty, so it is scored, has fingerprint zero
and no words, and its size in the mix is 0; rows without id are never learned from
and are kept last of their group; of repeated rows one stays; an empty table gives
no rows; further columns are kept by every stage, except that the last one puts its
own ``shard`` and ``slot`` in place of columns of those names.
"""

from pyspark.sql import DataFrame, SparkSession

from beatgrid.llm import decontaminate, mixing, quality_gbt, sharding, simhash_bk
from beatgrid.llm.common import table
from beatgrid.sources.staging import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the given labels, does not reject."""
    return quality_gbt.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_bk.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: The classifier and the fingerprints have no SQL; the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
