"""Compaction of record files run as a file stream.

Each run gathers the files that arrived since the last one and then stops, so a
monthly delivery does not re-read all earlier months. Progress is kept in the
checkpoint; a batch owns one folder of the table and overwrites it when it is
run again, so a restart never doubles rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beatgrid.schemas import record_schema
from beatgrid.sources.records import blanks_to_null, kind_glob, quoted_csv
from beatgrid.sources.staging import write_stage


def compact_new_files(spark: SparkSession, root: str, kind: str, out: str, checkpoint: str,
                      partition_col: str = "month") -> None:
    """Add the new files of a kind below ``<root>/<month>/`` to the table ``out``."""
    stream = quoted_csv(spark.readStream.schema(record_schema(kind))).csv(kind_glob(root, kind))

    def store(batch: DataFrame, batch_id: int) -> None:
        write_stage(batch, f"{out}/batch={batch_id}", partition_col)

    query = (
        blanks_to_null(stream).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_compacted(spark: SparkSession, out: str, kind: str) -> DataFrame:
    schema = record_schema(kind)
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(full).parquet(out).select(*schema.fieldNames())
