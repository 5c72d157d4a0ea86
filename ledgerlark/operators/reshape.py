"""Normal forms: splitting lists, finding dependencies, taking tables apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.sets import dealt_row_counts


# Rows that a task counts at once, and tasks that share the copies of one row.
ROWS_A_TASK = 500_000
SLICES = 64


def explode_lists(df: DataFrame, lists: dict[str, str], separator: str = ",") -> DataFrame:
    """One row per position of parallel lists kept as text (first normal form).

    ``lists`` maps a text column to the name of its element column. Lists of
    unequal length leave NULL at the missing positions. A NULL list has no elements;
    a row without any keeps one row, of NULL position and elements.
    """
    none = F.expr("array()").cast("array<string>")
    arrays = [F.coalesce(F.split(text, separator), none).alias(name) for text, name in lists.items()]
    kept = [c for c in df.columns if c not in lists]
    zipped = df.select(*kept, F.posexplode_outer(F.arrays_zip(*arrays)).alias("position", "item"))
    return zipped.select(*kept, "position", "item.*")


def dependency_violations(
    df: DataFrame, determinant: list[str], dependent: list[str]
) -> DataFrame:
    """Determinant values that go with more than one dependent value.

    The lowest and the highest dependent value decide, so one aggregation that
    combines on the map side is enough, whatever a hot determinant has.
    """
    value = F.struct(*dependent)
    return (
        df.groupBy(*determinant)
        .agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
        .where(~F.col("lowest").eqNullSafe(F.col("highest")))
    )


def determines(df: DataFrame, determinant: list[str], dependent: list[str]):
    """Does the dependency hold everywhere? A boolean scalar column."""
    broken = dependency_violations(df, determinant, dependent)
    return broken.agg(F.count(F.lit(1)) == 0).scalar()


def dimension(df: DataFrame, columns: list[str]) -> DataFrame:
    """The table a determinant and what it determines move to."""
    return df.select(*columns).distinct()


def lossless(original: DataFrame, rejoined: DataFrame) -> DataFrame:
    """Row counts of both sides and the distinct rows whose number differs.

    Rows are dealt out to tasks of about ``ROWS_A_TASK`` before they are counted, so what a task
    holds does not grow with the table; a row copied very often is dealt over ``SLICES`` of them.
    """
    counts = dealt_row_counts(original, rejoined.select(original.columns), ROWS_A_TASK, SLICES)
    return counts.agg(
        F.sum("left_rows").alias("original_rows"), F.sum("right_rows").alias("rejoined_rows"),
        F.count_if(F.col("left_rows") != F.col("right_rows")).alias("differing_rows"),
    )
