"""Session settings the library is designed for."""

# Runtime re-planning does the size-dependent work: it measures both sides of a
# join before it broadcasts one, splits skewed join and write partitions, and
# merges small shuffle partitions.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(builder, shuffle_partitions: int | None = None):
    """Apply the recommended settings to a ``SparkSession.builder``.

    On a cluster leave ``shuffle_partitions`` high (several per core); small
    ones are merged at run time.
    """
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder
