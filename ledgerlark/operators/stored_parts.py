"""Stored copies of a table in parts of its key, compared by checksums of the parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ledgerlark.operators.sets import row_differences

_PART = "_part"
_SUMS = f"{_PART} int, n long, one decimal(38,0), two decimal(38,0)"


@dataclass(frozen=True)
class StoredParts:
    """A copy of a table below ``path``: its rows in folders by part, and a checksum per part.

    A row's part is drawn from its key, of any type, so parts are even and a key is in one
    part of every copy; a NULL key has a part too. A checksum is the number of rows and two
    sums over hashes of whole rows, so neither the order of rows nor that of files matters,
    and repeated rows count as often as they occur.
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str
    parts: int

    def write(self, df: DataFrame) -> StoredParts:
        """Store ``df`` in a new folder. The checksums are those of the rows as stored; they come
        last, so a copy whose writing broke off has none and cannot be compared."""
        if _PART in df.columns:
            raise ValueError(f"column {_PART} is taken")
        part = F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(self.parts)).cast("int")
        # Rebalanced and not repartitioned: a key with many rows may have several files.
        dealt = df.select(*self.schema.names).withColumn(_PART, part).hint("rebalance", _PART)
        dealt.write.partitionBy(_PART).parquet(f"{self.path}/rows")
        stored = self._stored()
        stored.groupBy(_PART).agg(
            F.count(F.lit(1)).alias("n"), _sum(self.schema.names, 1).alias("one"), _sum(self.schema.names, 2).alias("two")
        ).coalesce(1).write.parquet(f"{self.path}/sums")
        return self

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(_PART, IntegerType())).parquet(f"{self.path}/rows")

    def sums(self) -> DataFrame:
        return self.spark.read.schema(_SUMS).parquet(f"{self.path}/sums")

    def rows(self, parts: list[int] | None = None) -> DataFrame:
        """All rows, or those of some parts, of which alone files are opened."""
        stored = self._stored()
        return (stored if parts is None else stored.where(F.col(_PART).isin(parts))).drop(_PART)


def _sum(names: list[str], seed: int) -> Column:
    """Sum of the hashes of rows. A hash passes over NULL, so it is told which columns are."""
    told = [column for name in names for column in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.sum(F.xxhash64(F.lit(seed), *told).cast("decimal(28,0)"))


def differing_parts(left: StoredParts, right: StoredParts) -> list[int]:
    """Parts whose checksums differ, or that only one copy has; no row is read.

    The driver gets at most as many numbers as the copies have parts.
    """
    if (left.parts, left.key, left.schema.names) != (right.parts, right.key, right.schema.names):
        raise ValueError("the copies are not parted alike")
    one, two = (
        copy.sums().select(_PART, F.struct("n", "one", "two").alias(side)) for copy, side in ((left, "left"), (right, "right"))
    )
    found = one.join(two, _PART, "full").where(~F.col("left").eqNullSafe(F.col("right")))
    return sorted(row[0] for row in found.select(_PART).collect())


def stored_differences(left: StoredParts, right: StoredParts) -> DataFrame:
    """Rows that occur a different number of times in two copies, with both numbers.

    Only parts with differing checksums are read; equal copies cost a look at their sums.
    Two different parts pass as equal only if their numbers of rows and both sums of 64-bit
    hashes agree.
    """
    parts = differing_parts(left, right)
    return row_differences(left.rows(parts), right.rows(parts))
