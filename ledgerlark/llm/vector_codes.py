"""Compression of vectors to one small code per part, fitted and applied in whole numbers.

Components become whole numbers on a fixed grid, vectors are cut into equal parts, and
each part is replaced by the index of the nearest entry of its codebook. Distances come
from matrix products of floats that are exact: whole numbers are cut into limbs so short
that no sum of products reaches 2^53, each pair of limbs is one product, and the products
are put together again as 64-bit integers, or as Python's integers where a value is too
large for those. The nearest entry is the first least one, so nothing depends on the order
of sums, on the number of tasks or on the machine.

A round of fitting reads all vectors, adds up each entry's parts within the tasks, by the
same limbs, and across them by one small shuffle; the driver sees one number per entry and
component. Codes are one pass more.

Defined cases: rows whose vector is null or holds a null or a component that is not finite
are dropped; a null id sorts behind all others; of equal ids the vector that is less comes
first; repeated rows count as often as they stand there; with fewer vectors than entries the
codebook has one entry per vector; shorter vectors are read as if zeros followed, up to the
longest length, rounded up to equal parts; an error beyond 64 bits is null, and so is a
label's sum with such an error; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.joins import join_to_summary
from ledgerlark.sources.scratch import materialize

GRID = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# Rows a task multiplies at once.
BLOCK_ROWS = 8192

_EXACT = 53
_LONG = 1 << 63


def limb_bits(width: int, rows: int = BLOCK_ROWS) -> int:
    """Bits of a limb so that neither a product of parts nor a sum over a block's rows reaches 2^53."""
    return min((_EXACT - 1 - max(width, 1).bit_length()) // 2, _EXACT - 1 - rows.bit_length())


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Floats whose sum, each shifted by its number of limbs, is ``values``; the last carries the sign."""
    out = []
    top = max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
    while top >> bits:
        low = values & ((1 << bits) - 1)
        out.append(low.astype(np.float64))
        values, top = values >> bits, (top >> bits) + 1
    return [*out, values.astype(np.float64)]


def _joined(products: list[tuple[int, np.ndarray]], wide: bool) -> np.ndarray:
    """The sum of exact products, each shifted by its number of bits."""
    total = None
    for shift, product in products:
        whole = product.astype(np.int64)
        whole = whole.astype(object) * (1 << shift) if wide else whole << shift
        total = whole if total is None else total + whole
    return total


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """floor(4096 * x), as 64-bit integers where all fit and as Python's otherwise."""
    if not vectors.size or np.abs(vectors).max() < 2.0 ** 48:
        return np.floor(vectors * GRID).astype(np.int64)
    whole = [math.floor(x) * GRID if abs(x) >= 2.0 ** 53 else math.floor(x * GRID) for x in vectors.ravel().tolist()]
    return np.array(whole, object).reshape(vectors.shape)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the first of equals) and its squared distance, for each row."""
    width = parts.shape[1]
    top = max((abs(int(x)) for a in (parts, entries) if a.size for x in (a.max(), a.min())), default=0)
    wide = 8 * max(width, 1) * top * top >= _LONG
    bits = limb_bits(width)
    dots = _joined([(bits * (i + j), a @ b.T) for i, a in enumerate(limbs(parts, bits)) for j, b in enumerate(limbs(entries, bits))], wide)
    kind = object if wide else np.int64
    own, other = parts.astype(kind), entries.astype(kind)
    gaps = (other * other).sum(axis=1)[None, :] - 2 * dots
    best = np.argmin(gaps, axis=1) if gaps.shape[1] else np.zeros(len(parts), np.int64)
    return best, gaps[np.arange(len(parts)), best] + (own * own).sum(axis=1)


@dataclass
class Codebooks:
    """``entries[p]`` are the whole-number entries of part p; ``width`` components each."""

    width: int
    entries: list[np.ndarray]

    def digest(self) -> str:
        numbers = ",".join(str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    """A list column as a matrix, short rows filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == length).all():
        return flat.reshape(len(column), length)
    out = np.zeros((len(column), length))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _pieces(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with their vectors on the grid."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(first, BLOCK_ROWS)
            yield block, on_grid(_vectors(block.column(0), books.width * PARTS))


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and all of whose components are finite numbers."""

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))

    return rows.where(F.col(vector).isNotNull() & F.forall(vector, finite))


def first_books(kept: DataFrame, vec_id: str, vector: str) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; None without vectors."""
    longest = kept.agg(F.max(F.size(vector))).first()[0]
    if longest is None:
        return None
    width = -(-longest // PARTS)
    seeds = kept.select(vec_id, vector).orderBy(F.asc_nulls_last(vec_id), vector).limit(ENTRIES).collect()
    whole = on_grid(_vectors(pa.array([list(row[1]) for row in seeds], pa.list_(pa.float64())), width * PARTS))
    return Codebooks(width, [whole[:, p * width:(p + 1) * width] for p in range(PARTS)])


def next_books(kept: DataFrame, vector: str, books: Codebooks) -> Codebooks:
    """One round: assign every part, then move each used entry to the floor of its parts' mean."""
    width, bits, count = books.width, limb_bits(books.width), len(books.entries[0])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        sizes = np.zeros((PARTS, count), np.int64)
        for _, whole in _pieces(batches, books):
            for p in range(PARTS):
                part = whole[:, p * width:(p + 1) * width]
                code, _ = nearest(part, books.entries[p])
                member = (code[None, :] == np.arange(count)[:, None]).astype(np.float64)
                sizes[p] += member.sum(axis=1).astype(np.int64)
                for level, limb in enumerate(limbs(part, bits)):
                    total = sums.setdefault(level, np.zeros((PARTS, count, width), np.int64))
                    total[p] += (member @ limb).astype(np.int64)
        for level, values in [(-1, sizes), *sums.items()]:
            flat = values.ravel()
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), level), pa.int32()), pa.array(used, pa.int64()), pa.array(flat[used], pa.int64())],
                names=["level", "slot", "total"])

    added = kept.select(vector).mapInArrow(add_up, "level int, slot long, total long")
    size, total = [0] * (PARTS * count), [0] * (PARTS * count * width)
    # At most a count per entry, and a sum per entry, component and limb.
    for row in added.groupBy("level", "slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        if row.level < 0:
            size[row.slot] = int(row.total)
        else:
            total[row.slot] += int(row.total) << (bits * row.level)
    fresh = []
    for p in range(PARTS):
        whole = [[total[(p * count + e) * width + i] // size[p * count + e] if size[p * count + e] else int(books.entries[p][e][i])
                  for i in range(width)] for e in range(count)]
        small = all(abs(x) < 1 << 62 for entry in whole for x in entry)
        fresh.append(np.array(whole, np.int64 if small else object).reshape(count, width))
    return Codebooks(width, fresh)


def fit(kept: DataFrame, vec_id: str, vector: str, rounds: int = ROUNDS) -> Codebooks | None:
    books = first_books(kept, vec_id, vector)
    for _ in range(rounds if books else 0):
        books = next_books(kept, vector, books)
    return books


def encode(kept: DataFrame, vector: str, books: Codebooks) -> DataFrame:
    """The other columns of ``kept`` with ``code``, two hex digits per part, and ``error``."""
    carried = [name for name in kept.columns if name != vector]
    schema = T.StructType([*(kept.schema[name] for name in carried), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = np.array([f"{e:02x}" for e in range(ENTRIES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, whole in _pieces(batches, books):
            code, error = np.full(block.num_rows, "", "U16"), np.zeros(block.num_rows, object)
            for p in range(PARTS):
                part = whole[:, p * books.width:(p + 1) * books.width]
                best, gap = nearest(part, books.entries[p])
                code = np.char.add(code, digits[best])
                error = error + gap.astype(object)
            yield pa.RecordBatch.from_arrays(
                [*block.columns[1:], pa.array(code.tolist(), pa.string()),
                 pa.array([e if e < _LONG else None for e in error.tolist()], pa.int64())],
                names=[field.name for field in schema.fields])

    return kept.select(vector, *carried).mapInArrow(run, schema)


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector."""
    names = [F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector")]
    kept = materialize(usable(rows.select(*names), "vector"), "vectors")
    books = fit(kept, "vec_id", "vector")
    if books is None:
        nothing = F.lit(None).cast("string")
        return kept.select("vec_id", nothing.alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), nothing.alias("codebooks_sha256"))
    # Inside a struct nulls compare as equal.
    coded = materialize(encode(kept, "vector", books).withColumn("group", F.struct("label")), "codes")
    total = F.when(F.count("error") == F.count(F.lit(1)), F.expr("try_sum(error)")).alias("label_error")
    groups = coded.groupBy("group").agg(F.count(F.lit(1)).alias("n"), total)
    return join_to_summary(coded, groups, "group", "n").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
