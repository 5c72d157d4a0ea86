"""Join forms that need care on large or skewed inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than one thousandth of all rows is hot; its rows are dealt out
# to this many tasks.
HOT_SHARE = 1000
SALTS = 64


def keys(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct key values for the right side of a semi or anti join.

    A key held by a third of the rows shrinks to one row per task before it is
    shuffled, so the join never sees the hot group.
    """
    return df.select(*columns).distinct()


def _matching(
    left: DataFrame, key: str, right: DataFrame, right_key: str, unique: bool, how: str
) -> DataFrame:
    found = F.col(right_key).alias(key)
    listed = right.select(found) if unique else keys(right, found)
    return left.join(listed, key, how).select(left.columns)


def having_match(
    left: DataFrame, key: str, right: DataFrame, right_key: str, unique: bool = False
) -> DataFrame:
    """Rows of ``left`` with at least one match (IN, EXISTS).

    Set ``unique`` where ``right_key`` is the key of its table: nothing has to be
    made distinct then, both sides come straight from a shuffle, and adaptive
    execution can split a hot key of ``left``.
    """
    return _matching(left, key, right, right_key, unique, "left_semi")


def without_match(
    left: DataFrame, key: str, right: DataFrame, right_key: str, unique: bool = False
) -> DataFrame:
    """Rows of ``left`` with no match (NOT EXISTS); a NULL key has no match."""
    return _matching(left, key, right, right_key, unique, "left_anti")


def join_to_summary(rows: DataFrame, summary: DataFrame, key: str, count: str) -> DataFrame:
    """Join rows to the one summary row of their key, spreading hot keys.

    A summary that was grouped by the key is not shuffled again for the join, which
    keeps adaptive execution from splitting a hot key. Keys with more than one
    ``HOT_SHARE``-th of the rows, of which there can be at most ``HOT_SHARE``, are
    therefore salted: their rows go to ``SALTS`` tasks and their summary row is
    copied to each. ``count`` is the summary's number of rows per key. The salt
    also depends on the task that reads a row, so equal copies of one row spread
    too, and a repeated task deals them out as before.
    """
    total = summary.agg(F.sum(count)).scalar()
    is_hot = F.col(count) * HOT_SHARE > total
    hot = summary.where(is_hot).select(key, F.lit(True).alias("_hot"))
    dealt = F.xxhash64(F.spark_partition_id(), *rows.columns)
    spread = F.pmod(dealt, F.lit(SALTS)).cast("int")
    salted = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(0)
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = summary.withColumn("_salt", F.explode(copies))
    return salted.join(copied, [key, "_salt"]).drop("_salt", "_hot")


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``left.key NOT IN (SELECT right_key FROM right)`` with SQL's NULL rules.

    An empty list keeps every row, a NULL in the list keeps none, and otherwise a
    NULL key is dropped. Spark's own plan for NOT IN broadcasts the list whatever
    its size; here the two NULL questions are one-row aggregates and the rest is
    an ordinary anti join.
    """
    facts = right.agg(
        F.struct(
            F.count(F.lit(1)).alias("size"), F.count_if(F.col(right_key).isNull()).alias("nulls")
        )
    ).scalar()
    rest = without_match(left, key, right.where(F.col(right_key).isNotNull()), right_key)
    known = F.col(key).isNotNull() | (facts["size"] == 0)
    return rest.where((facts["nulls"] == 0) & known)


def full_from_sides(
    left: DataFrame, right: DataFrame, key: str, left_columns: list[str], right_columns: list[str]
) -> DataFrame:
    """FULL OUTER as LEFT plus the right rows that found no partner."""
    order = [key, *left_columns, *right_columns]
    kept = left.join(right, key, "left").select(order)
    lone = right.join(left.select(key).distinct(), key, "left_anti")
    return kept.unionByName(lone, allowMissingColumns=True).select(order)


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Equi-join on every shared column name; refuses a silent cross product."""
    shared = sorted(set(left.columns) & set(right.columns))
    if not shared:
        raise ValueError("no shared column names")
    return left.join(right, shared, "inner")


def coverage(
    left: DataFrame, left_key: str, facts: DataFrame, column: str, values: DataFrame, measure: str
) -> DataFrame:
    """What each left key has of all values of ``column``, empty cells counted, not formed.

    Per left key: the sum of ``measure``, the number of values it has, and the number
    it lacks. NULL is a value like any other. The full grid of keys and values is
    never built: the empty cells of a key are all values less those it has.
    """
    cells = facts.groupBy(left_key, column).agg(F.sum(measure).alias(measure))
    held = cells.groupBy(left_key).agg(F.sum(measure).alias(measure), F.count(F.lit(1)).alias("held"))
    every = values.select(column).distinct().agg(F.count(F.lit(1))).scalar()
    had = F.coalesce("held", F.lit(0))
    return left.select(left_key).join(held, left_key, "left").select(
        left_key, F.coalesce(measure, F.lit(0)).alias(measure), had.alias("held"), (every - had).alias("lacking")
    )


def group_pairs(df: DataFrame, group: str, value: str) -> DataFrame:
    """Unordered pairs inside each group, counted without forming them.

    ``pairs`` is n(n-1)/2 as a 38-digit number, ``equal_pairs`` those with the same value, and
    ``widest_gap`` the largest difference any pair shows. Both steps combine on
    the map side, so a group with a third of all rows costs no more than others.
    """
    per_value = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_value.withColumn("_equal", pairs_of("n"))
        .groupBy(group)
        .agg(
            F.sum("n").alias("members"), F.sum("_equal").alias("equal_pairs"),
            (F.max(value) - F.min(value)).alias("widest_gap"),
        )
        .select(group, "members", pairs_of("members").alias("pairs"), "equal_pairs", "widest_gap")
    )


def pairs_of(count: str) -> Column:
    """n(n-1)/2 in whole numbers: the even one of the two factors is halved first."""
    half = F.expr(f"IF({count} % 2 = 0, {count} div 2, {count})").cast("decimal(19,0)")
    rest = F.expr(f"IF({count} % 2 = 0, {count} - 1, ({count} - 1) div 2)").cast("decimal(19,0)")
    return (half * rest).cast("decimal(38,0)")
