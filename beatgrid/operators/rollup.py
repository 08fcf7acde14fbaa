"""Counts of incidents up a nested area hierarchy.

Records are reduced once to long facts (keys, type, outcome, n). Coarser levels
are sums of facts, and wide tables are spread from long counts as the last step.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.labels import label_index
from beatgrid.operators.clean import prune
from beatgrid.operators.joins import join_reduced
from beatgrid.schemas import CROSSWALK_GUARD, CROSSWALK_KEEP

MATCH_ON = {"area_code": "small_code", "area_name": "small_name"}
PARENTS = ("mid_code", "mid_name", "district_code", "district_name")


@dataclass(frozen=True)
class Level:
    """An area level: its own columns and those of the areas that contain it."""
    name: str
    own: tuple[str, ...]
    parents: tuple[str, ...]

    @property
    def keys(self) -> tuple[str, ...]:
        return self.own + self.parents


SMALL = Level("small", ("area_code", "area_name"), PARENTS)
MID = Level("mid", PARENTS[:2], PARENTS[2:])
DISTRICT = Level("district", PARENTS[2:], ())
LEVELS = (SMALL, MID, DISTRICT)
PERIODS: Mapping[str, tuple[str, ...]] = {"month": ("month",), "year": ("year",), "all": ()}


# --- facts and parents --------------------------------------------------------

def long_facts(df: DataFrame, keys: Sequence[str], dims: Sequence[str] = (),
               count: str = "n") -> DataFrame:
    """Number of records per key and dimension."""
    return df.groupBy(*keys, *dims).agg(F.count(F.lit(1)).alias(count))


def crosswalk_distinct(crosswalk: DataFrame, keep: Sequence[str] = CROSSWALK_KEEP,
                       header_guard: Mapping[str, str] | None = None) -> DataFrame:
    """One row per small area and its parents, from one row per output area."""
    guard = CROSSWALK_GUARD if header_guard is None else header_guard
    return prune(crosswalk, keep, guard).dropDuplicates(list(keep))


def attach_parents(df: DataFrame, crosswalk: DataFrame, on: Mapping[str, str] = MATCH_ON,
                   parents: Sequence[str] = PARENTS) -> DataFrame:
    """Left join the parents on code and name. Misses stay, with NULL parents.

    The crosswalk is first reduced to one row per match key, so a key listed
    under two parents can never multiply rows.
    """
    unique = (
        crosswalk.groupBy(*[F.col(right).alias(left) for left, right in on.items()])
        .agg(F.min(F.struct(*parents)).alias("_parents"))
        .select(*on, *[F.col("_parents")[p].alias(p) for p in parents])
    )
    return join_reduced(df, unique, list(on), "left")


def crosswalk_conflicts(crosswalk: DataFrame, on: Sequence[str] = tuple(MATCH_ON.values()),
                        parents: Sequence[str] = PARENTS) -> DataFrame:
    """Match keys listed under several parents: one row per key and parents that breaks the dependency.

    ``n_rows`` counts the crosswalk rows, ``n_parents`` the different parents of the key, and ``used`` marks
    the ones that ``attach_parents`` takes. No rows mean that the parents follow from the keys.
    """
    listed = crosswalk.groupBy(*on, *parents).agg(F.count(F.lit(1)).alias("n_rows"))
    broken = (listed.groupBy(*on).agg(F.count(F.lit(1)).alias("n_parents"), F.min(F.struct(*parents)).alias("_first"))
              .filter(F.col("n_parents") > 1))
    found = join_reduced(listed, broken, on, "inner")
    return found.select(*on, *parents, "n_rows", "n_parents", F.struct(*parents).eqNullSafe(F.col("_first")).alias("used"))


def missing_parents(df: DataFrame, parent: str = PARENTS[0], count: str | None = None) -> DataFrame:
    """Rows (and records, where a count column is given) without a parent."""
    missed = F.col(parent).isNull()
    weight = F.lit(1) if count is None else F.col(count)
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    return df.agg(
        total(F.when(missed, 1).otherwise(0)).alias("rows_missed"),
        total(F.when(missed, weight).otherwise(0)).alias("records_missed"),
        total(weight).alias("records"),
    )


# --- roll-ups -----------------------------------------------------------------

def roll_up(facts: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Sum facts to coarser keys."""
    return facts.groupBy(*keys).agg(F.sum(count).alias(count))


def roll_up_all(facts: DataFrame, dims: Sequence[str] = (), levels: Sequence[Level] = LEVELS,
                periods: Mapping[str, tuple[str, ...]] = PERIODS, count: str = "n") -> DataFrame:
    """Every area level by every period, finest first in ``levels`` and ``periods``.

    An area level is first summed from the next finer one, then all its periods
    come from one grouping-sets aggregate, so rows are multiplied by the number
    of periods only, and only after they have been reduced to their level.
    ``area_level`` and ``period_level`` name the set a row belongs to: a missing
    parent is never mistaken for a column that the set leaves out.
    """
    period_columns = [c for columns in periods.values() for c in columns]
    area_columns = levels[0].keys
    period = reduce(
        lambda chain, item: F.when(F.grouping(item[1][0]) == 0, item[0]).otherwise(chain),
        [item for item in periods.items() if item[1]], F.lit("all"),
    )
    types = {f.name: f.dataType for f in facts.schema.fields}
    parts, finer = [], facts
    for depth, level in enumerate(levels):
        if depth:
            finer = roll_up(finer, [*level.keys, *period_columns, *dims], count)
        sets = [[*level.keys, *columns, *dims] for columns in periods.values()]
        summed = finer.groupingSets(sets, *level.keys, *period_columns, *dims).agg(
            F.sum(count).alias(count), period.alias("period_level"))
        shown = [F.col(c) if c in level.keys else F.lit(None).cast(types[c]).alias(c) for c in area_columns]
        parts.append(summed.select(
            F.lit(level.name).alias("area_level"), "period_level", *shown, *period_columns, *dims, count))
    return reduce(DataFrame.unionByName, parts)


# --- wide tables --------------------------------------------------------------

def cell_counts(df: DataFrame, keys: Sequence[str], crime_vocabulary: Mapping[str, str],
                outcome_vocabulary: Mapping[str, str], crime: str = "crime_type",
                outcome: str = "outcome", count: str | None = None) -> DataFrame:
    """Long counts per key and ``cell`` of the type-by-outcome grid.

    The grid has one extra line and column for labels outside the vocabularies,
    so every row falls into exactly one cell, and a key has at most as many rows
    as the grid has cells.
    """
    width = len(outcome_vocabulary) + 1
    cell = label_index(crime, crime_vocabulary) * width + label_index(outcome, outcome_vocabulary)
    amount = F.count(F.lit(1)) if count is None else F.sum(count)
    return df.groupBy(*keys, cell.alias("cell")).agg(amount.alias("n"))


def _total(cells: Sequence[int]) -> str:
    """Sum as a balanced tree, which keeps hundreds of terms shallow."""
    terms = [f"c{i}" for i in cells]
    while len(terms) > 1:
        pairs = [f"({terms[i]} + {terms[i + 1]})" for i in range(0, len(terms) - 1, 2)]
        terms = pairs + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def spread(cells: DataFrame, keys: Sequence[str], crime_vocabulary: Mapping[str, str],
           outcome_vocabulary: Mapping[str, str], together: Sequence[str] | None = None) -> DataFrame:
    """``total_obs``, one count per type, per outcome and per pair of both.

    The few cells of a key are brought together in long form (by ``together``,
    a subset of the keys that determines the rest), then spread within their
    partition; wide rows are never shuffled. Other columns are sums of cells.
    Partitions are as many as the session shuffles by, and not merged by their bytes:
    the cells of a key are few bytes, its wide row is many.
    """
    crimes, outcomes = list(crime_vocabulary.values()), list(outcome_vocabulary.values())
    lines, width = len(crimes) + 1, len(outcomes) + 1
    grid = [[line * width + column for column in range(width)] for line in range(lines)]
    flat = [cell for line in grid for cell in line]
    pivoted = (
        cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(k) for k in together or keys])
        .groupBy(*keys).pivot("cell", flat).agg(F.sum("n"))
        .selectExpr(*keys, *[f"coalesce(`{cell}`, 0L) AS c{cell}" for cell in flat])
    )
    return pivoted.selectExpr(
        *keys,
        f"{_total(flat)} AS total_obs",
        *[f"{_total(grid[i])} AS {slug}" for i, slug in enumerate(crimes)],
        *[f"{_total([line[j] for line in grid])} AS {slug}" for j, slug in enumerate(outcomes)],
        *[f"c{grid[i][j]} AS {a}{b}" for i, a in enumerate(crimes) for j, b in enumerate(outcomes)],
    )


def wide(df: DataFrame, keys: Sequence[str], crime_vocabulary: Mapping[str, str],
         outcome_vocabulary: Mapping[str, str], crime: str = "crime_type",
         outcome: str = "outcome", count: str | None = None) -> DataFrame:
    """Wide counts per key: cells counted in long form, then spread."""
    cells = cell_counts(df, keys, crime_vocabulary, outcome_vocabulary, crime, outcome, count)
    return spread(cells, keys, crime_vocabulary, outcome_vocabulary)


def wide_columns(crime_vocabulary: Mapping[str, str], outcome_vocabulary: Mapping[str, str]) -> list[str]:
    """Names of the count columns of a wide table, in order."""
    crimes, outcomes = list(crime_vocabulary.values()), list(outcome_vocabulary.values())
    return ["total_obs", *crimes, *outcomes, *[a + b for a in crimes for b in outcomes]]
