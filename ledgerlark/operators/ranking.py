"""Positions, ranks and pages over a total order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.sources.scratch import materialize

# monotonically_increasing_id keeps the partition above bit 33, the row below.
_ROW_BITS = 33

# A page is narrowed to a range of the order until about so many rows are left to sort.
PAGE_ROWS = 100_000

# Parts into which one pass of narrowing cuts the range.
PAGE_PARTS = 64


def _placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their place and, as ``_part``, their range partition."""
    slotted = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright("_slot", _ROW_BITS).alias("_part")
    row = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)
    # One row per range partition: small enough for one window and a broadcast.
    starts = (
        slotted.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_size").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_start"),
        )
    )
    return (
        slotted.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + row + 1).cast("bigint"))
        .select(*df.columns, name, "_part")
    )


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based place of each row; ``order`` must end in a unique key.

    ``row_number`` over an unpartitioned window would sort everything in one
    task. Here the rows are range-partitioned and sorted in parallel, numbered
    inside their partition, and shifted by the sizes of the partitions before.
    """
    return _placed(df, order, name).drop("_part")


def with_rank(
    df: DataFrame, value: str, order: list[Column], rank: str = "rank", position: str = "position"
) -> DataFrame:
    """RANK by ``value`` next to ROW_NUMBER: equal values share the first place.

    Only a partition's first value can have begun before it. Its rank is one row per
    partition and comes to the rows by a broadcast; so a value that fills many partitions
    is never shuffled. Every other value begins where it is found.
    """
    placed = _placed(df, order, position)
    # Inside a struct NULLs compare as equal, so rows without a value find their rank too.
    own = F.struct(F.col(value).alias("value"))
    runs = placed.groupBy("_part", own.alias("_value")).agg(F.min(position).alias("_first"))
    heads = runs.groupBy("_part").agg(F.min_by("_value", "_first").alias("_value"))
    begun = heads.join(runs.select("_value", "_first"), "_value").groupBy("_part").agg(
        F.first("_value").alias("_head"), F.min("_first").alias("_begun"))
    # One row per range partition.
    known = placed.join(F.broadcast(begun), "_part")
    continued = known.where(own == F.col("_head")).withColumn(rank, F.col("_begun"))
    inner = known.where(own != F.col("_head")).withColumn("_value", own)
    ranked = inner.join(runs.withColumnRenamed("_first", rank), ["_part", "_value"])
    columns = [*df.columns, rank, position]
    return continued.select(columns).unionByName(ranked.select(columns))


def page_by_offset(df: DataFrame, order: list[tuple[str, bool]], skip: int, size: int) -> DataFrame:
    """``LIMIT size OFFSET skip`` by ``order``, pairs of a column and whether it ascends.

    The ranges of the order that the page touches are narrowed by cuts taken from a sample,
    a pass over the input each, until few rows are left; only those are sorted. A value too
    frequent for that is narrowed by the next column. Columns may be of any type that can be
    ordered. NULLs come first in ascending and last in descending order. Nothing is written,
    the driver sees ``PAGE_PARTS`` counts a pass, and the filters found reach the scan.
    """
    pieces = _page(df, order, skip, size)
    if not pieces:
        return df.limit(0)
    return reduce(DataFrame.unionByName, pieces).orderBy(*_sort(order)).limit(size)


def _sort(order: list[tuple[str, bool]]) -> list[Column]:
    return [F.asc(name) if ascending else F.desc(name) for name, ascending in order]


def _page(rows: DataFrame, order: list[tuple[str, bool]], skip: int, size: int) -> list[DataFrame]:
    """Pieces that make up rows ``skip`` to ``skip + size`` of ``rows``, in no order."""
    if not order:  # alike in all columns: any will do
        return [rows.offset(skip).limit(size)]
    (name, ascending), pieces, before = order[0], [], 0
    cuts = _cuts(rows, name)
    found = rows.groupBy(_part(F.col(name), cuts).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    for part, n in sorted(((r["part"], r["n"]) for r in found), reverse=not ascending):
        low, high = max(skip - before, 0), min(skip + size - before, n)
        before += n
        if low >= high:
            continue
        piece = rows.where(_range(F.col(name), part, cuts))
        if high - low == n:
            pieces.append(piece)
        elif n <= PAGE_ROWS:
            pieces.append(piece.orderBy(*_sort(order)).offset(low).limit(high - low))
        else:
            single = part < 0 or part % 2 == 1
            pieces += _page(piece, order[1:] if single else order, low, high - low)
    return pieces


def _cuts(rows: DataFrame, name: str) -> list:
    """Up to ``PAGE_PARTS`` values that part the rows evenly, from a sample of bounded size."""
    drawn = rows.where(F.col(name).isNotNull()).select(name).orderBy(F.rand(PAGE_PARTS)).limit(PAGE_PARTS * PAGE_PARTS)
    values = sorted(row[0] for row in drawn.collect())
    return sorted({values[i * len(values) // PAGE_PARTS] for i in range(PAGE_PARTS)}) if values else []


def _part(column: Column, cuts: list) -> Column:
    """-1 for NULL, 2i + 1 for the i-th cut itself, 2i for what lies before it."""
    if not cuts:
        return F.when(column.isNull(), -1).otherwise(0)
    listed = F.array(*map(F.lit, cuts))
    below = F.size(F.filter(listed, lambda cut: cut < column))
    return F.when(column.isNull(), -1).otherwise(2 * below + F.array_contains(listed, column).cast("int"))


def _range(column: Column, part: int, cuts: list) -> Column:
    """The values of a part."""
    if part < 0:
        return column.isNull()
    i, single = divmod(part, 2)
    if single:
        return column == F.lit(cuts[i])
    low = column > F.lit(cuts[i - 1]) if i > 0 else None
    high = column < F.lit(cuts[i]) if i < len(cuts) else None
    if low is None and high is None:
        return column.isNotNull()
    return low if high is None else high if low is None else low & high


def with_new_ids(df: DataFrame, order: list[Column], last: Column, name: str) -> DataFrame:
    """Dense surrogate keys after ``last``, in the given order."""
    numbered = with_position(df, order, "_offset")
    return numbered.withColumn(name, F.col("_offset") + last).drop("_offset")
