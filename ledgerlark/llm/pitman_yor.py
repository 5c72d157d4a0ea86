"""Texts scored by a hierarchical Pitman-Yor language model of words after words.

Every word that stands before others is a restaurant: the tokens that follow it are its
customers, who sit at tables, one dish (token) to a table. Every table of such a restaurant
is a customer of the one parent that all share, where each dish has one table, because the
parent's own base spreads over endlessly many words. So only the seating below is sampled.

Seating is sampled by Gibbs. In a sweep all customers of a dish in a restaurant get up and
sit down anew, given the tables of all others after the sweep before. How many tables they
take is drawn from the exact distribution for up to ``EXACT`` customers (its weights are
products for up to ``FEW`` of them, sums of logarithms above); for more, they come
in one after another (in lots of an eighth of those who already sit), mindful of those still
to come, ``TRIALS`` times over, and one of the seatings is drawn by weights that make up for
coming in order. The first sweep starts from one table per dish. Predictive probabilities of
the sweeps after ``BURN_IN`` are averaged; one known class stands for all tokens that training
did not see. Draws depend on nothing but the dish, its restaurant and the sweep, so whoever
needs a seating can draw it, a task that runs again draws the same, and nothing depends on how
the rows are dealt out.

The texts are read once into units, runs of whole texts of a bounded size, which keep their
words' hashes and their tokens; the pairs of words are formed anew whenever they are needed,
because they would take as much room again. A unit asks for the counts of its distinct words
and pairs of words: the sorted hashes go to buckets of hash
ranges, each key once per unit, are added up there, and the sums go back to the unit that
asked. A frequent word or pair so has a row per unit at most, and a bucket a bounded number of
keys. Words are told apart by one 64-bit hash.

A pair seen once has one table for good, so only pairs seen more often are seated anew. Of the
units that know such a pair, the one that a hash chooses hands it to a cell of a grid, by the
hash ranges of its first and of its second word. A sweep reads the cells alone: each pair is
seated once, a cell sends the tables of its words to the words' buckets, and the sums go back
to the cells. The units are told at the end: tables of each word after the first sweep that
counts, and after the others those that differ from it, and of each pair the sum over these sweeps.

Defined cases: a null or empty text is its end alone; a null id counts as an empty text and
so is held out; repeated rows are counted and scored each; a text longer than a unit is a
unit of its own; without training texts every token has probability one; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.blocks import LOWER, SPACES, Block, Prefixes, blocks, mix, rows_of, word_bounds
from ledgerlark.llm.packing import grow, pack_keys, shrink, unpack_keys
from ledgerlark.sources.scratch import discard, materialize, release, run_folder

SWEEPS = 20
BURN_IN = 10
EXACT = 512
FEW = 32
TRIALS = 2
STRENGTH = 1.0
FOLDS = 10
ADDED = 0.1

# Text in a unit, and keys in a bucket: what a task holds at once.
UNIT_BYTES = 4 << 20
BUCKET_KEYS = 2_000_000

# What stands for the end of a text and for the place before its first word.
END, START = np.uint64(0x8F1D6A3B5C27E94D), np.uint64(0x3C9E5B70A1D24F86)

_ASKED = "unit long, bucket int, data binary"

# Who sends what pairs seen once add to the words of cells, and what stands where
# a bucket would: a cell's pairs, their tables, the tables that they add to a bucket's words,
# those that pairs seen once add, and a bucket's figures.
ONES = -(1 << 62)
PAIRS, SEATS, LEDGER, WORDS, FIGURES = -2, -1, -3, -4, -5


# Seating ------------------------------------------------------------------------------

@lru_cache(maxsize=8)
def ways(discount: float) -> np.ndarray:
    """log of the weight of all seatings of c customers at t tables, for c and t up to ``EXACT``."""
    table = np.full((EXACT + 1, EXACT + 2), -np.inf)
    table[1, 1] = 0.0
    t = np.arange(1, EXACT + 1)
    for c in range(1, EXACT):
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + table[c, 1:-1]
        table[c + 1, 1:-1] = np.logaddexp(table[c, :-2], np.where(t <= c, stay, -np.inf))
    return table


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each key, sweep and step."""
    bits = mix(key + mix(np.full(1, (sweep << 32) + step + 1, np.uint64)))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def binomial(u: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Successes of n trials: by inversion, or by the normal law where both outcomes are many."""
    flip = p > 0.5
    q = np.where(flip, 1 - p, p)
    out = np.zeros(len(p))
    many = np.flatnonzero(n * q > 50)
    if len(many):
        v, size, share = u[many], n[many], q[many]
        deviation = np.sqrt(-2 * np.log(np.minimum(v, 1 - v)))
        # A rational approximation of the normal quantile, exact to 5e-4.
        quantile = deviation - (2.515517 + 0.802853 * deviation + 0.010328 * deviation ** 2) / (
            1 + 1.432788 * deviation + 0.189269 * deviation ** 2 + 0.001308 * deviation ** 3)
        middle = size * share
        out[many] = np.clip(np.rint(middle + np.where(v < 0.5, -1, 1) * quantile * np.sqrt(middle * (1 - share))), 0, size)
    # A bound of the chance of none saves most their exact one.
    open_ = np.flatnonzero((u > 1 - n * q) & (n * q <= 50))
    size, share = n[open_], q[open_]
    chance = np.exp(size * np.log1p(-share))
    left, k = u[open_] - chance, 0
    while len(open_):
        on = (left > 0) & (k < size)
        open_, size, share, chance, left = open_[on], size[on], share[on], chance[on], left[on]
        k += 1
        out[open_] = k
        chance = chance * (size - k + 1) / k * share / (1 - share)
        left = left - chance
    return np.where(flip, n - out, out).astype(np.int64)


def _in_order(c: np.ndarray, base: np.ndarray, slope: np.ndarray, discount: float, key: np.ndarray, sweep: int, trial: int):
    """Tables when customers come one after another, and the log weight that makes up for it; c descends."""
    tables, weight = np.ones(len(c), np.int64), np.zeros(len(c))
    seated, step = 1, trial << 20
    active = int(np.searchsorted(-c, -seated))
    while active:
        some = slice(0, active)
        lot = np.minimum(max(1, seated // 8), c[some] - seated).astype(np.float64)
        stay, new = seated + (lot - 1) / 2 - discount * tables[some], base[some] + slope[some] * tables[some]
        # A table opened now takes the discount from the weight of all who come later; that
        # weight grows by one with each of them, less the discount for the tables they open.
        whole, later = stay + new, c[some] - seated
        share = 1 - discount * np.minimum(new * np.log1p(later / whole) / np.maximum(later, 1), 1)
        ahead = (whole / (whole + later * share)) ** (discount / share)
        # Half of a lot sit before its middle, and some of them at tables of their own.
        stay = stay - discount * (lot - 1) / 2 * new * ahead / (stay + new * ahead)
        all_ = stay + new * ahead
        opened = binomial(uniform(key[some], sweep, step), lot, new * ahead / all_)
        weight[some] += lot * np.log(all_) - opened * np.log(ahead)
        tables[some] += opened
        seated, step = seated + max(1, seated // 8), step + 1
        active = int(np.searchsorted(-c, -seated))
    return tables, weight


def tables(c: np.ndarray, base: np.ndarray, slope: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables that c customers take, where a new table weighs ``base + slope * own tables``."""
    out = np.minimum(c, 1)
    order = np.argsort(-c, kind="stable")
    falling = c[order]
    log_ways = ways(discount)
    edges = np.searchsorted(-falling, -np.arange(EXACT, 0, -1)).tolist()
    for count, low, high in zip(range(EXACT, 1, -1), edges, edges[1:]):
        rows = order[low:high]
        if not len(rows):
            continue
        if count <= FEW:
            # Weights as multiples of that of one table; so few cannot leave the range of a double.
            steps = np.exp(np.diff(log_ways[count, 1:count + 1]))[:, None]
            total = 1 + np.cumsum(np.cumprod((base[rows] + slope[rows] * np.arange(1, count)[:, None]) * steps, axis=0), axis=0)
            drawn = uniform(key[rows], sweep, 0) * total[-1]
            out[rows] = 1 + (drawn > 1) + (total[:-1] < drawn).sum(axis=0)
            continue
        j = np.arange(count)
        weight = np.cumsum(np.log(base[rows, None] + slope[rows, None] * j), axis=1) + log_ways[count, 1:count + 1]
        total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        out[rows] = 1 + (total < (uniform(key[rows], sweep, 0) * total[:, -1])[:, None]).sum(axis=1)
    rows = order[:edges[0]]
    if len(rows):
        trials = [_in_order(c[rows], base[rows], slope[rows], discount, key[rows], sweep, i) for i in range(TRIALS)]
        weight = np.stack([w for _, w in trials])
        total = np.cumsum(np.exp(weight - weight.max(axis=0)), axis=0)
        pick = (total < uniform(key[rows], sweep, TRIALS << 20) * total[-1]).sum(axis=0)
        out[rows] = np.stack([t for t, _ in trials])[pick, np.arange(len(rows))]
    return out


# Units ----------------------------------------------------------------------------------

def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of texts, ends included, and their number by text; small blocks bound the arrays per byte."""
    parts = [_tokens(block) for block in blocks(texts)]
    return np.concatenate([keys for keys, _ in parts]), np.concatenate([sizes for _, sizes in parts])


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[block.data]
    starts, ends = word_bounds(data, block.offsets, SPACES)
    row = rows_of(starts, block.offsets)
    keys = np.full(len(starts) + block.rows, END)
    keys[np.arange(len(starts)) + row] = Prefixes(data).slices(starts, ends)
    return keys, np.bincount(row, minlength=block.rows) + 1


def _ascending(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned 64-bit keys, by sorting values, which is faster than sorting places."""
    bits = np.uint64(max(len(keys).bit_length(), 1))
    mark = (np.uint64(1) << bits) - np.uint64(1)
    fits = len(keys) and int(keys.max()) >> (64 - int(bits)) == 0
    # In place, because a task holds many arrays of this length.
    order = keys << bits if fits else keys & ~mark
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= mark
    order = order.view(np.int64)
    if not fits:
        falls = keys[order]
        # Keys that differ in their lowest bits alone may be out of order.
        if (falls[1:] < falls[:-1]).any():
            return np.argsort(keys, kind="stable")
    return order


def _merged(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each key among them, the order of the keys, and where each distinct one starts in it."""
    order = _ascending(keys)
    falls = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = falls[1:] != falls[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(fresh) - 1
    start = np.flatnonzero(fresh)
    return falls[start], place, order, start


def _codes(tokens: np.ndarray, sizes: np.ndarray, words: int, start: int) -> np.ndarray:
    """Code (first word * words + second word) of the pair that each token ends."""
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = start
    return (before * words + tokens).view(np.uint64)


def _units(docs: DataFrame) -> DataFrame:
    """A row per unit; docs has an id, whether it is held out, and a text."""
    schema = T.StructType([
        T.StructField("unit", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[0].dataType)),
        *(T.StructField(name, T.BinaryType()) for name in ("words", "texts")),
        T.StructField("n_words", T.LongType()), T.StructField("n_pairs", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch.column(2), UNIT_BYTES):
                part = batch.slice(block.first, block.rows)
                keys, sizes = _hashed(part.column(2))
                words, place, *_ = _merged(np.append(keys, START))
                codes = np.sort(_codes(place[:-1], sizes, len(words), place[-1]))
                packed = [shrink(keys=pack_keys(words)), shrink(tokens=place[:-1], sizes=sizes, held=part.column(1).to_numpy(zero_copy_only=False))]
                ids = pa.ListArray.from_arrays(pa.array([0, block.rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit]), ids, *(pa.array([p], pa.binary()) for p in packed), pa.array([len(words)]),
                     pa.array([1 + int((codes[1:] != codes[:-1]).sum())])], names=schema.names)
                unit += 1

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Settings:
    """What all tasks know: totals and the discounts, of the parent and of the restaurants."""

    tokens: int = 0
    types: int = 0
    parent: float = 0.5
    discount: float = 0.5
    customers: tuple[int, ...] = ()


class Unit:
    """A unit's words, the tokens of its texts, and what it was told so far; its distinct pairs of words follow from the tokens."""

    def __init__(self, words: bytes, texts: bytes, told: dict[str, list[bytes]]):
        self.words, raw = unpack_keys(grow(words)["keys"]), grow(texts)
        self.tokens, self.sizes, self.held = raw["tokens"], raw["sizes"], raw["held"]
        self.train = np.repeat(~self.held, self.sizes)
        self.start, self.end = (int(np.searchsorted(self.words, mark)) for mark in (START, END))
        self.told = told

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, ...]:
        codes, pair, *_ = _merged(_codes(self.tokens, self.sizes, len(self.words), self.start))
        return *np.divmod(codes.view(np.int64), len(self.words)), pair

    @property
    def first(self) -> np.ndarray:
        return self._pairs[0]

    @property
    def second(self) -> np.ndarray:
        return self._pairs[1]

    @property
    def pair(self) -> np.ndarray:
        """The pair that each token ends."""
        return self._pairs[2]

    @property
    def key(self) -> np.ndarray:
        return mix(mix(self.words)[self.first] + self.words[self.second])

    @cached_property
    def order(self) -> np.ndarray:
        return _ascending(self.key)

    def answer(self, name: str) -> dict[str, np.ndarray]:
        """The answers of all buckets, one after the other: as the keys were, in ascending order."""
        parts = [grow(data) for data in self.told[name]]
        return {field: np.concatenate([part[field] for part in parts]) for field in parts[0]}

    def by_pair(self, values: np.ndarray) -> np.ndarray:
        """Values in the order of the keys, by pair."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = values
        return out

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the pairs, and the pairs that this unit hands on."""
        pair = self.answer("pair_counts")
        return self.by_pair(pair["total"]), self.by_pair(pair["mine"])

    def parent(self, settings: Settings, known: np.ndarray, customers: np.ndarray, sweep: int) -> np.ndarray:
        """The shared parent's probability of each word; unknown words are one class."""
        unknown = STRENGTH + settings.parent * settings.types
        return np.where(known, np.maximum(customers - settings.parent, 0), unknown) / (STRENGTH + settings.customers[sweep])


# Asking -----------------------------------------------------------------------------------

def _bucketed(keys: np.ndarray, count: int, **values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Ascending keys with their values, cut into buckets of hash ranges."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(bucket, np.arange(count + 1))
    for i in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        cut = slice(edges[i], edges[i + 1])
        yield i, shrink(keys=pack_keys(keys[cut]), **{name: value[cut] for name, value in values.items()})


def _summed(parts: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Distinct keys of all parts, the place of each part's keys among them, the parts' sizes, and sums of every value."""
    each = [unpack_keys(part["keys"]) for part in parts]
    sizes = np.array([len(keys) for keys in each])
    distinct, place, _, _ = _merged(np.concatenate(each))
    sums: dict[str, np.ndarray] = {}
    for part, last, size in zip(parts, np.cumsum(sizes), sizes):
        for name in part.keys() - {"keys"}:
            # No part has a key twice.
            sums.setdefault(name, np.zeros(len(distinct), np.int64))[place[last - size:last]] += part[name]
    return distinct, place, sizes, sums


def _answered(asked: DataFrame, least: int, tell_mine: bool) -> DataFrame:
    """Totals by key, back to each unit in the order of its keys, places among the keys of at least some total, and figures of each bucket."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), table.column(2).to_pylist()))
        parts = [grow(data) for _, _, data in rows]
        each = [unpack_keys(part["keys"]) for part in parts]
        ends = np.cumsum([len(keys) for keys in each])
        distinct, place, order, start = _merged(np.concatenate(each))
        total = np.bincount(place, weights=np.concatenate([part["total"] for part in parts])).astype(np.int64)
        figures = [int(total.sum()), int((total >= 1).sum()), int((total == 1).sum()), int((total == 2).sum())]
        mine = np.zeros(len(place), bool)
        times = np.diff(start, append=len(place)).astype(np.uint64)
        mine[order[start + (mix(distinct) % times).astype(np.int64)]] = True
        wanted = total >= least
        rank = np.cumsum(wanted) - 1
        data, places = [], []
        for low, high in zip((0, *ends), ends):
            at = place[low:high]
            data.append(shrink(total=total[at], **({"mine": mine[low:high]} if tell_mine else {})))
            places.append(shrink(gaps=np.diff(rank[at[wanted[at]]], prepend=0)))
        return pa.table({"unit": pa.array([row[0] for row in rows], pa.int64()), "bucket": pa.array([row[1] for row in rows], pa.int32()),
                         "data": pa.array(data, pa.binary()), "places": pa.array(places, pa.binary()),
                         "figures": pa.array([figures if i == 0 else None for i in range(len(data))], pa.list_(pa.int64()))})

    return asked.groupBy("bucket").applyInArrow(run, f"{_ASKED}, places binary, figures array<long>")


class Gathering:
    """The units and what they were told, all laid out by unit, so that none is moved twice."""

    def __init__(self, docs: DataFrame):
        self.spark: SparkSession = docs.sparkSession
        self.names: list[str] = []
        self.told: dict[str, DataFrame] = {}
        self.places: dict[str, DataFrame] = {}
        self.paths: dict[str, str] = {}
        self.count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.units = self._laid_out(_units(docs).repartition(self.count, "unit"), "units")
        self.sizes = self.units.agg(F.sum("n_words"), F.sum("n_pairs")).first()

    def _laid_out(self, df: DataFrame, label: str) -> DataFrame:
        name = f"{label}_{uuid.uuid4().hex}"
        self.names.append(name)
        df.write.format("parquet").bucketBy(self.count, "unit").option(
            "path", run_folder(self.spark, label)).saveAsTable(name)
        release(self.spark)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def keep(self, name: str, rows: DataFrame) -> None:
        """What units are told under a name, in the order of buckets."""
        listed = F.sort_array(F.collect_list(F.struct("bucket", "data")))["data"]
        self.told[name] = self._laid_out(rows.repartition(self.count, "unit").groupBy("unit").agg(listed.alias(name)), name)

    def ask(self, name: str, asked: DataFrame, least: int = 0, tell_mine: bool = False) -> list[int]:
        """Send keys to their buckets and keep what comes back, and the places; the figures of all keys."""
        path = run_folder(self.spark, name)
        answers = _answered(asked, least, tell_mine)
        answers.write.parquet(path)
        answers = self.spark.read.schema(answers.schema).parquet(path)
        self.keep(name, answers.select("unit", "bucket", "data"))
        self.paths[name] = run_folder(self.spark, "places")
        answers.select("unit", "bucket", F.col("places").alias("data")).write.parquet(self.paths[name])
        self.places[name] = self.spark.read.schema(_ASKED).parquet(self.paths[name])
        row = answers.agg(*(F.sum(F.col("figures")[i]) for i in range(4))).first()
        discard(path)
        return [value or 0 for value in row]

    def forget(self, name: str) -> None:
        """Delete the places, once all units were told by them."""
        discard(self.paths[name])

    def buckets(self, keys: str) -> int:
        return -(-self.sizes[f"sum({keys})"] // BUCKET_KEYS) * (8 if keys == "n_pairs" else 4)

    def each(self, names: list[str], work: Callable[..., Iterator[pa.RecordBatch]], schema: T.StructType | str, with_ids: bool = False) -> DataFrame:
        """``work`` on every unit, told what stands under the names: with its number, or with the ids of its texts."""
        own = ["unit", "words", "texts", *(["ids"] if with_ids else [])]
        rows = reduce(lambda left, name: left.join(self.told[name], "unit"), names, self.units.select(*own))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = dict(zip(batch.schema.names, (column[i] for column in batch.columns)))
                    unit = Unit(row["words"].as_py(), row["texts"].as_py(), {name: row[name].as_py() for name in names})
                    yield from work(row["ids"].values if with_ids else row["unit"].as_py(), unit)

        return rows.select(*own, *names).mapInArrow(run, schema)


def _rows(parts: Iterable[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """What goes from units to buckets, or to cells, in one batch."""
    columns = [*zip(*parts)] or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], names=["unit", "bucket", "data"])


def _discount(figures: list[int]) -> float:
    """From the keys that occur once and twice."""
    once, twice = figures[2], figures[3]
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once + twice else 0.5


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    own = F.col(f"`{doc_id}`")
    gathering = Gathering(docs.select(own.alias("id"), held_out(own).alias("held"), F.col(f"`{text}`").alias("text")))
    try:
        found = materialize(_scored(gathering, docs.schema[doc_id].dataType, sweeps, burn_in), "scores")
    finally:
        gathering.drop()
    return found.withColumnRenamed("id", doc_id)


def _scored(gathering: Gathering, id_type: T.DataType, sweeps: int, burn_in: int) -> DataFrame:
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    if gathering.sizes[0] is None:
        return gathering.spark.createDataFrame([], schema)
    words, pairs = gathering.buckets("n_words"), gathering.buckets("n_pairs")

    def ask_words(unit: int, it: Unit):
        total = np.bincount(it.tokens[it.train], minlength=len(it.words))
        yield _rows((unit, *part) for part in _bucketed(it.words, words, total=total))

    def ask_pairs(unit: int, it: Unit):
        total = np.bincount(it.pair[it.train], minlength=len(it.first))
        yield _rows((unit, *part) for part in _bucketed(it.key[it.order], pairs, total=total[it.order]))

    tokens, types, *_ = gathering.ask("word_counts", gathering.each([], ask_words, _ASKED))
    figures = gathering.ask("pair_counts", gathering.each([], ask_pairs, _ASKED), least=2, tell_mine=True)
    used = list(range(min(burn_in + 1, sweeps), sweeps + 1))
    settings = _sampled(gathering, Settings(tokens, types, 0.5, _discount(figures)), figures[1] - figures[2], words, pairs, sweeps, used)

    def finish(ids: pa.Array, it: Unit):
        word, (c, _), samples = it.answer("word_counts")["total"], it.counts(), it.answer("samples")
        customers = word.copy()
        customers[it.start] = word[it.end]
        known, full, degree = word > 0, customers > 0, np.bincount(it.first, minlength=len(word))
        seats = np.minimum(c, 1) * len(used)
        listed = seats[it.order]
        listed[c[it.order] > 1] = it.answer("seats")["seen"]
        seats = it.by_pair(listed)
        chance = np.zeros(len(c))
        for sweep in used:
            below, above = (_at_sweep(samples, name, sweep) for name in ("below", "above"))
            share = np.where(full, (STRENGTH + settings.discount * below) / (STRENGTH + customers), 1)
            chance += np.repeat(share, degree) * it.parent(settings, known, above, sweep)[it.second]
        chance += np.where(full[it.first], (c * len(used) - settings.discount * seats) / (STRENGTH + customers[it.first]), 0)
        log = np.log10(chance / len(used))[it.pair]
        base = np.log10((word + ADDED) / (settings.tokens + ADDED * (settings.types + 1)))[it.tokens]
        count = len(it.sizes)
        text = np.repeat(np.arange(count), it.sizes)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(it.held), pa.array(it.sizes, pa.int64()),
             pa.array(np.bincount(text, weights=known[it.tokens], minlength=count).astype(np.int64)),
             pa.array(np.full(count, settings.tokens)), pa.array(np.bincount(text, weights=base, minlength=count)),
             pa.array(np.bincount(text, weights=log, minlength=count))], names=schema.names)

    return gathering.each(["word_counts", "pair_counts", "samples", "seats"], finish, schema, with_ids=True)


# Sweeps -----------------------------------------------------------------------------------

def _at_sweep(samples: dict[str, np.ndarray], name: str, sweep: int) -> np.ndarray:
    """Tables of each word after a sweep, from those after the first that is used and what differs from them."""
    values = samples[name].copy()
    if f"{name}{sweep}" in samples:
        values[samples[f"{name}_differs"]] += samples[f"{name}{sweep}"]
    return values


class Cell:
    """Pairs seen more than once, and the words they consist of."""

    def __init__(self, pairs: bytes):
        raw = grow(pairs)
        self.words = unpack_keys(raw["keys"])
        self.first, self.second, self.c = (raw[name] for name in ("first", "second", "times"))
        self.key = mix(mix(self.words)[self.first] + self.words[self.second])

    @staticmethod
    def packed(words: np.ndarray, first: np.ndarray, second: np.ndarray, c: np.ndarray) -> bytes:
        return shrink(keys=pack_keys(words), first=first, second=second, times=c)

    def sums(self, buckets: int, t: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Tables of each word, for the words' buckets."""
        below, above = (np.bincount(side, weights=t, minlength=len(self.words)).astype(np.int64) for side in (self.first, self.second))
        return _bucketed(self.words, buckets, below=below, above=above)

    def seated(self, settings: Settings, own: np.ndarray, told: list[bytes], sweep: int) -> np.ndarray:
        """Tables of each pair after a sweep, from the one before."""
        parts = [grow(data) for data in told]
        below, above = (np.concatenate([part[name] for part in parts]) for name in ("below", "above"))
        others = below[self.first] - own
        chance = (np.maximum(above[self.second] - own, 1) - settings.parent) / (STRENGTH + settings.customers[sweep - 1])
        return tables(self.c, (STRENGTH + settings.discount * others) * chance, settings.discount * chance, settings.discount, self.key, sweep)


def _grouped(rows: DataFrame, column: str, count: int, work: Callable[[int, list[tuple[int, bytes]]], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """``work`` on all rows of each of ``count`` cells or buckets; small rows are much work, so few are a task."""
    own, other = (0, 1) if column == "unit" else (1, 0)
    tasks = min(count, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column(other).to_pylist(), table.column(2).to_pylist()), key=lambda row: row[0])
        out = list(work(table.column(own)[0].as_py(), rows))
        return pa.table({"unit": pa.array([row[0] for row in out], pa.int64()), "bucket": pa.array([row[1] for row in out], pa.int32()),
                         "data": pa.array([row[2] for row in out], pa.binary())})

    return rows.repartition(tasks, column).groupBy(column).applyInArrow(run, _ASKED)


def _gathered(cell: int, rows: list[tuple[int, bytes]], words: int) -> Iterator[tuple[int, int, bytes]]:
    """What units handed to a cell as one, and its first tables, one a pair."""
    parts = [Cell(data) for _, data in rows]
    distinct, place, *_ = _merged(np.concatenate([part.words for part in parts]))
    start = np.cumsum([0, *(len(part.words) for part in parts)])
    first, second = (np.concatenate([place[at + getattr(part, side)] for at, part in zip(start, parts)]) for side in ("first", "second"))
    c = np.concatenate([part.c for part in parts])
    # Those with many customers first, as they are seated, and so that no sweep has to sort them.
    falling = np.argsort(-c, kind="stable")
    packed = Cell.packed(distinct, first[falling], second[falling], c[falling])
    yield cell, PAIRS, packed
    for bucket, data in Cell(packed).sums(words, np.ones(len(first))):
        yield cell, bucket, data


def _started(bucket: int, rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """Tables of a bucket's words while each pair has one, and what pairs seen once add to the words of cells."""
    distinct, _, _, sums = _summed([grow(data) for _, data in rows])
    above = sums["above"]
    ours = [(unit, grow(data)) for unit, data in rows if unit < 0]
    figures = [int(above.sum()), int((above == 1).sum()), int((above == 2).sum()), 0]
    if ours:
        keys, _, _, own = _summed([part for _, part in ours])
        at = np.searchsorted(distinct, keys)
        figures[3] = int(above[at].sum())
        yield ONES, bucket, shrink(keys=pack_keys(keys), **{name: sums[name][at] - own[name] for name in ("below", "above")})
        for unit, part in ours:
            at = np.searchsorted(distinct, unpack_keys(part["keys"]))
            yield unit, bucket, shrink(**{name: sums[name][at] for name in ("below", "above")})
        yield bucket, LEDGER, shrink(keys=pack_keys(keys), **{f"{name}0": own[name] for name in ("below", "above")})
    once = {name: sums[name].copy() for name in ("below", "above")}
    if ours:
        for name, values in once.items():
            values[np.searchsorted(distinct, keys)] -= own[name]
    yield bucket, WORDS, shrink(keys=pack_keys(distinct), **once)
    yield bucket, FIGURES, shrink(figures=np.array(figures))


def _added(bucket: int, rows: list[tuple[int, bytes]], sweep: int) -> Iterator[tuple[int, int, bytes]]:
    """Tables of a bucket's words after a sweep, to the cells that asked, and those of the cells' pairs alone."""
    parts = [grow(data) for _, data in rows]
    distinct, place, sizes, sums = _summed(parts)
    # Rows are sorted, so what pairs seen once add comes first and knows every word.
    own = {name: sums[name] - parts[0][name] for name in ("below", "above")}
    for (unit, _), low, high in list(zip(rows, np.cumsum(sizes) - sizes, np.cumsum(sizes)))[1:]:
        yield unit, bucket, shrink(**{name: sums[name][place[low:high]] for name in ("below", "above")})
    yield bucket, LEDGER, shrink(keys=pack_keys(distinct), **{f"{name}{sweep}": own[name] for name in ("below", "above")})
    yield bucket, FIGURES, shrink(figures=np.array([int(sums["above"].sum())]))


def _sampled(gathering: Gathering, settings: Settings, frequent: int, words: int, pairs: int, sweeps: int, used: list[int]) -> Settings:
    """Run the sweeps over the pairs seen more than once, and tell the units of those that are used."""
    spark, grid, paths = gathering.spark, max(1, int(np.ceil(np.sqrt(frequent / max(BUCKET_KEYS // 4, 1))))), []

    def written(label: str, rows: DataFrame) -> tuple[DataFrame, str]:
        path = run_folder(spark, label)
        paths.append(path)
        rows.write.parquet(path)
        return spark.read.schema(_ASKED).parquet(path), path

    def figures(rows: DataFrame) -> np.ndarray:
        """Sums of a row of numbers a bucket."""
        return sum(grow(row.data)["figures"] for row in rows.where(f"bucket = {FIGURES}").select("data").collect())

    def hand_on(unit: int, it: Unit):
        c, mine = it.counts()
        once, more = mine & (c == 1), np.flatnonzero(mine & (c > 1))
        below, above = (np.bincount(side[once], minlength=len(it.words)) for side in (it.first, it.second))
        out = [(unit, *part) for part in _bucketed(it.words, words, below=below, above=above)]
        row, column = (((it.words >> np.uint64(32)) * np.uint64(grid) >> np.uint64(32)).astype(np.int64)[side[more]] for side in (it.first, it.second))
        cell = row * grid + column
        more, cell = more[np.argsort(cell, kind="stable")], np.sort(cell)
        for low, high in zip(*(np.searchsorted(cell, np.unique(cell), side) for side in ("left", "right"))):
            some = more[low:high]
            known, place, *_ = _merged(np.concatenate([it.first[some], it.second[some]]).view(np.uint64))
            out.append((-1 - int(cell[low]), PAIRS, Cell.packed(it.words[known.view(np.int64)], place[:len(some)], place[len(some):], c[some])))
        yield _rows(out)

    handed, handed_path = written("handed", gathering.each(["pair_counts"], hand_on, _ASKED))
    cells, _ = written("cells", _grouped(handed.where("unit < 0"), "unit", grid * grid, lambda cell, rows: _gathered(cell, rows, words)))
    static = cells.where(f"bucket = {PAIRS}")
    answers, path = written("started", _grouped(handed.where("unit >= 0").unionByName(cells.where("bucket >= 0")), "bucket", words, _started))
    first = figures(answers)
    once, twice, rest = int(first[1]), int(first[2]), int(first[0] - first[3])
    settings = Settings(settings.tokens, settings.types, _discount([0, 0, once, twice]), settings.discount, (int(first[0]),))
    ones, _ = written("ones", answers.where(f"unit = {ONES}"))
    ledgers = [written("ledger", answers.where(f"bucket = {WORDS}{f' OR bucket = {LEDGER}' if used[0] == 0 else ''}"))]
    discard(handed_path)
    seats = None
    for sweep in range(1, sweeps + 1):
        def seat(cell: int, rows: list[tuple[int, bytes]], settings: Settings = settings, sweep: int = sweep):
            it = Cell(rows[0][1])
            kept = grow(rows[1][1]) if rows[1][0] == SEATS else {"tables": np.ones(len(it.c), np.int64), "seen": np.zeros(len(it.c), np.int64)}
            t = it.seated(settings, kept["tables"], [data for bucket, data in rows if bucket >= 0], sweep)
            seen = kept["seen"] + (t if sweep in used else 0)
            yield cell, SEATS, shrink(tables=t, seen=seen)
            for bucket, data in it.sums(words, t):
                yield cell, bucket, data

        told = answers.where(f"unit < 0 AND unit <> {ONES}")
        before = [path, *([seats_path] if seats is not None else [])]
        state = static if seats is None else static.unionByName(seats.where(f"bucket = {SEATS}"))
        seats, seats_path = written("seats", _grouped(state.unionByName(told), "unit", grid * grid, seat))
        answers, path = written("added", _grouped(
            ones.unionByName(seats.where("bucket >= 0")), "bucket", words, lambda bucket, rows, sweep=sweep: _added(bucket, rows, sweep)))
        for old in before:
            discard(old)
        release(spark)
        settings = replace(settings, customers=(*settings.customers, rest + int(np.sum(figures(answers)))))
        if sweep in used:
            ledgers.append(written("ledger", answers.where(f"bucket = {LEDGER}")))

    def seen(cell: int, rows: list[tuple[int, bytes]]):
        it = Cell(rows[0][1])
        total = grow(rows[1][1])["seen"] if len(rows) > 1 else np.ones(len(it.c), np.int64)
        order = np.argsort(it.key)
        for bucket, data in _bucketed(it.key[order], pairs, seen=total[order]):
            yield cell, bucket, data

    def tell(bucket: int, rows: list[tuple[int, bytes]], values_of: Callable[[dict[str, np.ndarray]], Callable[[np.ndarray], dict[str, np.ndarray]]]):
        """Values of the bucket's keys, to each unit at its places; nothing to those with none."""
        told = values_of(_summed([grow(data) for unit, data in rows if unit < 0])[3] if rows[0][0] < 0 else {"seen": np.zeros(0, np.int64)})
        for unit, data in rows:
            if unit >= 0:
                yield unit, bucket, shrink(**told(np.cumsum(grow(data)["gaps"])))

    def samples(sums: dict[str, np.ndarray]) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
        zero = np.zeros(len(sums["below"]), np.int64)
        firsts = {name: sums.get(f"{name}{used[0]}", zero) for name in ("below", "above")}
        base = {name: sums[name] + first for name, first in firsts.items()}
        later = {name: [sums.get(f"{name}{sweep}", zero) - first for sweep in used[1:]] for name, first in firsts.items()}
        differs = {name: reduce(np.logical_or, (values != 0 for values in each), zero != 0) for name, each in later.items()}

        def told(at: np.ndarray) -> dict[str, np.ndarray]:
            out = {}
            for name in firsts:
                out |= {name: base[name][at], f"{name}_differs": differs[name][at]}
                # Many words have the same tables after all sweeps.
                some = at[out[f"{name}_differs"]]
                out |= {f"{name}{sweep}": values[some] for sweep, values in zip(used[1:], later[name])}
            return out

        return told

    state = static if seats is None else static.unionByName(seats.where(f"bucket = {SEATS}"))
    gathering.keep("seats", _grouped(gathering.places["pair_counts"].unionByName(_grouped(state, "unit", grid * grid, seen)), "bucket", pairs,
                                     lambda bucket, rows: tell(bucket, rows, lambda sums: lambda at: {"seen": sums["seen"][at]})))
    gathering.forget("pair_counts")
    last = {at for _, at in ledgers}
    for old in [at for at in paths if at not in last]:
        discard(old)
    ledger = reduce(DataFrame.unionByName, [df.select(F.lit(-1).cast("long").alias("unit"), F.col("unit").cast("int").alias("bucket"), "data") for df, _ in ledgers])
    gathering.keep("samples", _grouped(gathering.places["word_counts"].unionByName(ledger), "bucket", words,
                                       lambda bucket, rows: tell(bucket, rows, samples)))
    gathering.forget("word_counts")
    for old in last:
        discard(old)
    return settings
