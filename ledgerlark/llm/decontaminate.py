"""Benchmark decontamination by searching suffix arrays of the training texts.

Each block of training texts is a shard. The shard's suffixes that can match at all
(those that open with words some test suffix opens with) are sorted by their leading
words; every test suffix is then binary-searched in that array, which yields each
place where a window of it stands verbatim. Windows that continue one another on the
same diagonal are merged, which gives the longest matches and their places. The test
side is the stated query set and goes to the tasks in blocks of a bounded number of
words; training texts never move.

Words are compared by 64-bit hashes. Defined cases: a null or empty text has no words
and no match; a test item without words matches nothing; an item of fewer words than a
window is one window; repeated rows, repeated ids and repeated items are each matched
for themselves; a null item id still contaminates but is not listed; empty tables give
no rows or no matches; further columns of either table are ignored by the search and
kept by the removal, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.blocks import ALNUM_GAPS, LOWER, Block, Prefixes, blocks, rows_of, sequence_hash, word_bounds

WINDOW = 10
SEED_WORDS = 3
TEST_BLOCK_WORDS = 1_000_000

ADDED = "n_words long, n_hit long, matches array<struct<item_id:string,doc_word:int,item_word:int,words:int>>"
_ARROW_MATCH = pa.list_(pa.struct([
    ("item_id", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32()),
]))


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a block, lower-cased in A to Z."""
    data = LOWER[block.data]
    starts, ends = word_bounds(data, block.offsets, ALNUM_GAPS)
    return Prefixes(data).slices(starts, ends), rows_of(starts, block.offsets)


def _key(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, width: int) -> np.ndarray:
    """The words from each start, up to its stop, as one comparable byte string."""
    table = np.zeros((len(starts), width), ">u8")
    for i in range(width):
        here = starts + i
        ok = here < stops
        table[ok, i] = words[here[ok]]
    return table.view(f"S{8 * width}").ravel()


@dataclass
class TestBlock:
    """The suffixes of some test items, by the window that opens each."""

    seed_words: int
    seeds: np.ndarray
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    ids: list

    @staticmethod
    def of(rows: list[tuple], window: int) -> TestBlock | None:
        texts = pa.array([text for _, text in rows], pa.string())
        words, owner = [], []
        for block in blocks(texts):
            found, row = words_of(block)
            words.append(found)
            owner.append(row + block.first)
        words, owner = np.concatenate(words), np.concatenate(owner)
        sizes = np.bincount(owner, minlength=len(rows))
        if not len(words):
            return None
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(words)) - begin[owner]
        length = np.minimum(window, sizes)[owner]
        opens = np.flatnonzero(place + length <= sizes[owner])
        length = length[opens]
        seed_words = int(min(SEED_WORDS, length.min()))
        low = _key(words, opens, opens + length, window)
        order = np.lexsort((low, length))
        low, length, opens = low[order], length[order], opens[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (length[1:] != length[:-1])
        heads = np.flatnonzero(new)
        high = np.frombuffer(low[heads].astype(f"S{8 * window}").tobytes(), np.uint8).reshape(-1, 8 * window).copy()
        for i, size in enumerate(length[heads]):
            high[i, 8 * size:] = 0xFF
        return TestBlock(
            seed_words,
            np.unique(sequence_hash(words, seed_words)[opens]),
            low[heads],
            high.view(f"S{8 * window}").ravel(),
            length[heads],
            np.append(heads, len(low)),
            owner[opens],
            place[opens],
            [None if item is None else str(item) for item, _ in rows],
        )


def test_blocks(tests: DataFrame, id_column: str, text_column: str, window: int) -> list[TestBlock]:
    """Read the query set block by block; no block holds more than its bound of words."""
    made, rows, room = [], [], TEST_BLOCK_WORDS
    for item, text in tests.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).toLocalIterator():
        size = len(text or "") // 2 + 1
        if rows and size > room:
            made.append(TestBlock.of(rows, window))
            rows, room = [], TEST_BLOCK_WORDS
        rows.append((item, text))
        room -= size
    if rows:
        made.append(TestBlock.of(rows, window))
    return [block for block in made if block is not None]


def _windows(words: np.ndarray, stops: np.ndarray, test: TestBlock, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word position, test window) of every verbatim occurrence in a shard."""
    seeds = sequence_hash(words, test.seed_words)
    at = np.searchsorted(test.seeds, seeds)
    at[at == len(test.seeds)] = 0
    able = np.flatnonzero(test.seeds[at] == seeds)
    keys = _key(words, able, stops[able], window)
    order = np.argsort(keys, kind="stable")
    able, keys = able[order], keys[order]
    low = np.searchsorted(keys, test.low, side="left")
    high = np.searchsorted(keys, test.high, side="right")
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return able[low[which] + step], which


def search(block: Block, tests: list[TestBlock], window: int) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
    """Per row: words, words hit, and the maximal matches."""
    words, row = words_of(block)
    n_words = np.bincount(row, minlength=block.rows)
    begin = np.cumsum(n_words) - n_words
    stops = (begin + n_words)[row] if len(row) else row
    cover = np.zeros(len(words) + 1, np.int64)
    found: list[tuple] = []
    for test in tests:
        position, which = _windows(words, stops, test, window)
        if not len(position):
            continue
        length = test.lengths[which]
        np.add.at(cover, position, 1)
        np.add.at(cover, position + length, -1)
        items = test.first[which + 1] - test.first[which]
        place = np.repeat(np.arange(len(which)), items)
        slot = test.first[which][place] + np.arange(len(place)) - np.repeat(np.cumsum(items) - items, items)
        item, at, position, length = test.owners[slot], test.places[slot], position[place], length[place]
        order = np.lexsort((position, position - at, item))
        item, at, position, length = item[order], at[order], position[order], length[order]
        new = np.ones(len(item), bool)
        new[1:] = ((item[1:] != item[:-1]) | (position[1:] != position[:-1] + 1) | (at[1:] != at[:-1] + 1)
                   | (row[position[1:]] != row[position[:-1]]))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(item)) - 1
        size = position[tails] + length[tails] - position[heads]
        mine = row[position[heads]]
        found += zip(mine.tolist(), (position[heads] - begin[mine]).tolist(), at[heads].tolist(), size.tolist(),
                     [test.ids[i] for i in item[heads].tolist()])
    found.sort(key=lambda m: (m[0], m[1], m[4] or "", m[2]))
    hit = np.add.reduceat(np.append(np.cumsum(cover)[:-1] > 0, False).astype(np.int64), begin) if block.rows else begin
    hit = np.where(n_words > 0, hit, 0)
    matches = [{"item_id": m[4], "doc_word": m[1], "item_word": m[2], "words": m[3]} for m in found]
    return n_words, hit, matches, np.bincount([m[0] for m in found], minlength=block.rows)


def find_matches(
    docs: DataFrame, tests: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, carry: list[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` (all, unless named) with ``n_words``, ``n_hit`` and ``matches``:
    every maximal verbatim match of a window's length or more, with its place in the document
    and in the item."""
    share = docs.sparkSession.sparkContext.broadcast(test_blocks(tests, item_id, item_text, window))
    columns = docs.columns
    kept = range(len(columns)) if carry is None else [columns.index(name) for name in carry]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), *T.StructType.fromDDL(ADDED).fields])
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(at)):
                n_words, hit, matches, counts = search(block, share.value, window)
                offsets = np.zeros(block.rows + 1, np.int32)
                np.cumsum(counts, out=offsets[1:])
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(matches, _ARROW_MATCH.value_type))],
                    names=[field.name for field in schema.fields],
                )

    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, tests: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a test window stands."""
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    kept = find_matches(inner, tests, f"c{docs.columns.index(text)}", window=window).where("n_hit = 0")
    return kept.drop("n_words", "n_hit", "matches").toDF(*docs.columns)
