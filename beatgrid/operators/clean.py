"""Record cleaning: pruning, completeness, de-duplication, audit.

No operator here gathers the rows of a key in one task. Survivors are chosen by
aggregates that reduce before the shuffle, so a key holding a large share of all
rows reaches its reducer as one row per map task. Where all rows of a key must
be kept, they are selected by a join that runtime re-planning may split.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from beatgrid.functions.folds import seeded_order
from beatgrid.functions.text import all_blank, all_filled, is_blank, is_filled
from beatgrid.sources.staging import write_stage


def prune(df: DataFrame, keep: Sequence[str], header_guard: Mapping[str, str] | None = None) -> DataFrame:
    """Keep some columns, and drop header lines left inside concatenated text."""
    for column, text in (header_guard or {}).items():
        df = df.filter(~F.col(column).eqNullSafe(text))
    return df.select(*keep)


def drop_unlocatable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every location column is blank."""
    return df.filter(~all_blank(columns))


def completeness(required: Sequence[str], optional: str | None = None) -> Column:
    """Score of a row. With an optional column: 2 if all are filled, 1 if only
    the optional one is blank, else 0. Without: 1 if all are filled, else 0."""
    core = all_filled(required)
    if optional is None:
        return F.when(core, 1).otherwise(0)
    return F.when(core & is_filled(optional), 2).when(core, 1).otherwise(0)


def with_completeness(df: DataFrame, required: Sequence[str], optional: str | None = None,
                      name: str = "score") -> DataFrame:
    return df.withColumn(name, completeness(required, optional))


# --- groups of a key ----------------------------------------------------------

def key_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicated_keys(df: DataFrame, keys: Sequence[str], blank_key: str | None = None) -> DataFrame:
    """Keys seen at least twice; with ``blank_key`` only where that key is filled."""
    rows = df if blank_key is None else df.filter(is_filled(blank_key))
    return key_sizes(rows, keys).filter(F.col("n") >= 2)


def score_range(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"))


def _matching(df: DataFrame, other: DataFrame, columns: Sequence[str],
              never_null: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose columns equal a row of ``other``. NULL equals NULL,
    which costs an extra join key for every column that may hold one."""
    renamed = other.select(*[F.col(c).alias(f"_other_{i}") for i, c in enumerate(columns)])
    condition = [
        F.col(c) == F.col(f"_other_{i}") if c in never_null else F.col(c).eqNullSafe(F.col(f"_other_{i}"))
        for i, c in enumerate(columns)
    ]
    return df.join(renamed, condition, "left_semi")


def unique_or_blank(df: DataFrame, keys: Sequence[str], blank_key: str) -> DataFrame:
    """Rows whose key occurs once, and every row whose ``blank_key`` is blank.

    Blank rows pass without a shuffle. A key that occurs once has its row as
    its own minimum, so no join back is needed.
    """
    rest = [c for c in df.columns if c not in keys]
    singles = (
        df.filter(is_filled(blank_key))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row"))
        .filter(F.col("_n") == 1)
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )
    return df.filter(is_blank(blank_key)).unionByName(singles)


def duplicated_rows(df: DataFrame, keys: Sequence[str], blank_key: str) -> DataFrame:
    """All rows of keys seen at least twice and not blank."""
    rows = df.filter(is_filled(blank_key))
    return _matching(rows, duplicated_keys(rows, keys), keys, [blank_key])


def keep_best(df: DataFrame, keys: Sequence[str], score: str = "score",
              duplicated_only: str | None = None) -> DataFrame:
    """Rows whose score is the best of their key, ties included.

    ``duplicated_only`` names the key column that must be filled; only keys seen
    at least twice are then considered. Size and best score of a key come from
    the same aggregate, so this is still one join.
    """
    rows = df if duplicated_only is None else df.filter(is_filled(duplicated_only))
    best = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(score).alias(score))
    if duplicated_only is not None:
        best = best.filter(F.col("n") >= 2)
    return _matching(rows, best, [*keys, score], [score, duplicated_only])


# --- de-duplication -----------------------------------------------------------

def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(columns or df.columns))


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None,
                seed: str | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the seeded shuffle (if
    a seed is given), then by all other columns in order, missing values first."""
    rest = [c for c in df.columns if c not in keys]
    lead = list(order_by or [])
    if seed is not None:
        lead.append(seeded_order(seed, df.columns))
    rank = [column.alias(f"_r{i}") for i, column in enumerate(lead)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rank, *rest)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _survivor_groups(df: DataFrame, keys: Sequence[str], score: Column, blank_key: str | None,
                     order_by: Sequence[Column], *more: Column) -> tuple[DataFrame, dict[str, Column]]:
    """One group per surviving row, and the survivor's columns as expressions.

    Filled keys group by key and keep their best row. A row whose ``blank_key``
    is blank has no identity: the whole row is its group, so equal rows merge
    and the row is shuffled once, as a group key.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [(-score).alias("_rank"), *[column.alias(f"_r{i}") for i, column in enumerate(order_by)]]
    candidate = F.struct(*rank, *rest)
    value = {c: F.col(c) for c in keys}
    if blank_key is None:
        groups = df.groupBy(*keys).agg(F.min(candidate).alias("_best"), *more)
        value.update({c: F.col("_best")[c] for c in rest})
    else:
        own = F.when(is_blank(blank_key), F.struct(*rest))
        best = F.min(F.when(is_filled(blank_key), candidate))
        groups = df.groupBy(*keys, own.alias("_own")).agg(best.alias("_best"), *more)
        value.update({c: F.coalesce(F.col("_own")[c], F.col("_best")[c]) for c in rest})
    return groups, value


def dedup_by_completeness(df: DataFrame, keys: Sequence[str], required: Sequence[str],
                          optional: str | None = None, blank_key: str | None = None,
                          order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the most complete one; ties go to the smallest row.

    With ``blank_key`` rows that lack that key are only reduced to distinct rows.
    Both rules are one aggregate over one scan.
    """
    score = completeness(required, optional)
    groups, value = _survivor_groups(df, keys, score, blank_key, order_by)
    return groups.select(*[value[c].alias(c) for c in df.columns])


# --- audit --------------------------------------------------------------------

def _audited_groups(df: DataFrame, keys: Sequence[str], required: Sequence[str], optional: str,
                    blank_key: str, location: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """The survivors of ``dedup_by_completeness`` with the counts of their groups, and every stage size as a sum over them."""
    score = completeness(required, optional)
    rows_with = lambda s: F.sum(F.when(score == s, 1).otherwise(0))
    groups, value = _survivor_groups(
        df, keys, score, blank_key, (),
        F.count(F.lit(1)).alias("_n"), rows_with(2).alias("_n2"), rows_with(1).alias("_n1"))
    survivors = groups.select("_n", "_n1", "_n2", *[value[c].alias(c) for c in df.columns])
    n = F.col("_n")
    single = is_blank(blank_key) | (n == 1)
    at_best = (
        F.when(F.col("_n2") > 0, F.col("_n2")).when(F.col("_n1") > 0, F.col("_n1")).otherwise(n)
    )
    always, one = F.lit(True), F.lit(1)
    total = lambda condition, weight: F.coalesce(
        F.sum(F.when(condition, weight).otherwise(0)), F.lit(0)).cast("bigint")
    return survivors, [
        total(always, n).alias("before"),
        total(single, n).alias("unique_or_blank"),
        total(single, one).alias("unique_or_blank_distinct"),
        total(~single, n).alias("duplicated"),
        total(~single, at_best).alias("duplicated_best"),
        total(~single, one).alias("survivors"),
        total(always, one).alias("recombined"),
        total(~all_blank(location), one).alias("locatable"),
    ]


def audit(df: DataFrame, keys: Sequence[str], required: Sequence[str], optional: str,
          blank_key: str, location: Sequence[str]) -> DataFrame:
    """One row with the size of every cleaning stage, from one pass over the rows.

    Groups are those of ``dedup_by_completeness``; every stage size is a
    conditional sum over them.
    """
    survivors, sizes = _audited_groups(df, keys, required, optional, blank_key, location)
    return survivors.agg(*sizes)


def clean_observed(df: DataFrame, path: str, keys: Sequence[str], required: Sequence[str], optional: str,
                   blank_key: str, location: Sequence[str]) -> DataFrame:
    """Write the de-duplicated, locatable rows to ``path``, and return the row of ``audit``.

    The sizes are observed while the rows are written, in the tasks that write them, so
    cleaning and audit are one scan and one shuffle.
    """
    survivors, sizes = _audited_groups(df, keys, required, optional, blank_key, location)
    seen = Observation("cleaning")
    kept = survivors.observe(seen, *sizes).filter(~all_blank(location)).select(*df.columns)
    write_stage(kept, path)
    found = seen.get
    names = list(found)
    schema = ", ".join(f"`{name}` bigint" for name in names)
    return df.sparkSession.createDataFrame([tuple(found[name] for name in names)], schema)
