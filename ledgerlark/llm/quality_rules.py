"""Document quality by base rules and by divergence from a language's usual text.

The reference of a language is counted over the whole corpus: how its characters fall
into classes, and which words are common (each at least one in ``COMMON`` of the
language's words, so at most ``COMMON`` of them). A document is compared with its
language by the Jensen-Shannon distance (base 2, so 0 to 1) of both histograms; words
that are not common share one bin. A distance counts against a document only if the
document is long enough for its histogram to mean something.

References of languages with at least one in ``LANGUAGES`` of all words hold at most
``COMMON * LANGUAGES`` words together, whatever the corpus, and are broadcast. A smaller
language of at least ``LEAST_WORDS`` words has its own reference too, which is joined to its
documents. Any other language, and a null one, is measured against the pooled text of all
languages, but that distance rejects nothing: only the base rules judge such a document.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows
and ids are each judged for themselves; an empty table gives no rows; further columns
are ignored by the measures and kept by the filter, whatever their names; texts are read
whole, and no word crosses a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.blocks import SPACES, Block, Prefixes, blocks, rows_of, sequence_hash, word_bounds
from ledgerlark.sources.scratch import materialize

COMMON = 500
LANGUAGES = 1000
POOLED = ""

# Words from which a smaller language has a reference; a common word then stands 20 times.
LEAST_WORDS = 10_000

# Least words or characters for a distance to count, and the largest distance allowed.
MIN_WORDS = 50
MIN_CHARS = 200
MAX_WORD_DISTANCE = 0.45
MAX_CHAR_DISTANCE = 0.30

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars_all long, "
            "char_distance double, word_distance double, own_reference boolean")

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_STARTS = (np.arange(256) & 0xC0) != 0x80

# Character classes by first byte: small, capital, digit, space, line end, sentence
# marks, brackets and quotes, other marks, control, beyond ASCII.
CLASSES = 10
_CLASS = np.full(256, 9, np.int64)
_CLASS[:0x20] = 8
_CLASS[0x7F] = 8
_CLASS[0x21:0x7F] = 7
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[ord(" "), ord("\t")]] = 3
_CLASS[[ord("\n"), ord("\r")]] = 4
_CLASS[[ord(c) for c in ".,;:!?"]] = 5
_CLASS[[ord(c) for c in "()[]{}\"'-"]] = 6

_KIND_CLASS, _KIND_WORD, _KIND_WORDS = 0, 1, 2


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _class_table(block: Block) -> np.ndarray:
    """Characters of each class in each row."""
    heads = np.flatnonzero(_STARTS[block.data])
    row = rows_of(heads, block.offsets)
    return np.bincount(row * CLASSES + _CLASS[block.data[heads]], minlength=block.rows * CLASSES).reshape(-1, CLASSES)


def _words(block: Block) -> tuple[np.ndarray, np.ndarray, Prefixes]:
    starts, ends = word_bounds(block.data, block.offsets, SPACES)
    prefixes = Prefixes(block.data)
    return prefixes.slices(starts, ends), rows_of(starts, block.offsets), prefixes


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys that occur again, and of those that occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    twice = again.copy()
    twice[order[:-1][same]] = True
    return twice, again


def _dup_lines(block: Block, prefixes: Prefixes) -> np.ndarray:
    breaks = np.flatnonzero(block.data == 0x0A)
    edges = block.offsets[:-1]
    starts = np.sort(np.concatenate([breaks + 1, edges]))
    ends = np.sort(np.concatenate([breaks, block.offsets[1:]]))
    row = np.sort(np.concatenate([rows_of(breaks, block.offsets), np.arange(block.rows)]))
    filled = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(~SPACES[block.data], out=filled[1:])
    full = filled[ends] > filled[starts]
    starts, ends, row = starts[full], ends[full], row[full]
    keys = prefixes.slices(starts, ends) ^ sequence_hash(row.astype(np.uint64), 1)
    return np.bincount(row[_repeated(keys)[1]], minlength=block.rows)


def _repeat_words(words: np.ndarray, row: np.ndarray, rows: int, size: int = 5) -> np.ndarray:
    if len(words) < size:
        return np.zeros(rows, np.int64)
    keys = sequence_hash(words, size) ^ sequence_hash(row[:len(words) - size + 1].astype(np.uint64), 1)
    whole = np.flatnonzero(row[:len(row) - size + 1] == row[size - 1:])
    twice = whole[_repeated(keys[whole])[0]]
    cover = np.zeros(len(words) + 1, np.int64)
    cover[twice] += 1
    cover[twice + size] -= 1
    return np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=rows)


def _distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts from a reference; 0 for empty rows."""
    total = counts.sum(axis=1, keepdims=True)
    mine = counts / np.maximum(total, 1)
    middle = (mine + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(mine > 0, mine * np.log2(mine / middle), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0)


@dataclass
class Reference:
    """Shares of the character classes, and the common words with theirs (the rest last)."""

    classes: np.ndarray
    words: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of(classes: dict[int, int], words: dict[int, int], total: int) -> Reference:
        counts = np.zeros(CLASSES)
        for key, n in classes.items():
            counts[key] = n
        common = sorted((key % (1 << 64), n / total) for key, n in words.items())
        shares = [share for _, share in common]
        return Reference(counts / max(counts.sum(), 1), np.array([key for key, _ in common], np.uint64),
                         np.array([*shares, max(0.0, 1 - sum(shares))]))


@dataclass
class References:
    """Those of large languages with the pooled one under ``POOLED``, and those of small ones as rows, if any."""

    large: dict[str, Reference]
    small: DataFrame | None = None


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """The references of all languages that have enough words, and the pooled one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).cast(pa.string())
            for block in blocks(batch.column(1)):
                names, which = np.unique(
                    np.array([x or POOLED for x in langs.slice(block.first, block.rows).to_pylist()], object).astype(str),
                    return_inverse=True,
                )
                classes = _class_table(block)
                words, row, _ = _words(block)
                for i, name in enumerate(names):
                    found, counts = np.unique(words[which[row] == i], return_counts=True)
                    keys = np.concatenate([np.arange(CLASSES), found.view(np.int64), [0]])
                    kinds = np.concatenate([np.full(CLASSES, _KIND_CLASS), np.full(len(found), _KIND_WORD), [_KIND_WORDS]])
                    sums = np.concatenate([classes[which == i].sum(axis=0), counts, [counts.sum()]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([str(name)] * len(keys)), pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()),
                         pa.array(sums, pa.int64())], names=["lang", "kind", "key", "n"])

    counted = docs.select(F.col(f"`{lang}`"), F.col(f"`{text}`")).mapInArrow(count, "lang string, kind int, key long, n long")
    counted = materialize(counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "quality-counts")
    totals = counted.where(f"kind = {_KIND_WORDS}").select("lang", F.col("n").alias("words"))
    everything = totals.agg(F.sum("words").alias("all_words"))
    large = totals.where(F.col("lang") != POOLED).crossJoin(F.broadcast(everything)).where(
        F.col("words") * LANGUAGES >= F.col("all_words"))
    pooled = counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    own = counted.join(F.broadcast(large), "lang").select("lang", "kind", "key", "n", "words")
    whole = pooled.crossJoin(F.broadcast(everything)).select(
        F.lit(POOLED).alias("lang"), "kind", "key", "n", F.col("all_words").alias("words"))
    wanted = (F.col("kind") == _KIND_CLASS) | (F.col("kind") == _KIND_WORD) & (F.col("n") * COMMON >= F.col("words"))
    parts = {POOLED: ({}, {}, 1)}
    for row in own.unionByName(whole).where(wanted).collect():
        found = parts.setdefault(row.lang, ({}, {}, row.words))
        found[0 if row.kind == _KIND_CLASS else 1][row.key] = row.n
        parts[row.lang] = (*found[:2], row.words)
    made = {name: Reference.of(*found) for name, found in parts.items()}
    small = totals.where((F.col("lang") != POOLED) & (F.col("words") >= LEAST_WORDS)).join(
        F.broadcast(large.select("lang")), "lang", "left_anti")
    if small.isEmpty():
        return References(made)
    rest = counted.join(F.broadcast(large.select("lang")), "lang", "left_anti").join(small, "lang").where(wanted)
    pairs = F.collect_list(F.struct("kind", "key", "n"))
    return References(made, rest.groupBy(F.col("lang").alias("ref_lang")).agg(
        pairs.alias("ref_counts"), F.max("words").alias("ref_words")))


def _distances(
    block: Block, langs: list, words: np.ndarray, row: np.ndarray, known: dict[str, Reference]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    classes = _class_table(block)
    by_char, by_word = np.zeros(block.rows), np.zeros(block.rows)
    names = np.array([x if x in known else POOLED for x in langs], object)
    for name in set(names.tolist()):
        mine = np.flatnonzero(names == name)
        reference = known[name]
        by_char[mine] = _distance(classes[mine], reference.classes)
        local = np.full(block.rows, -1)
        local[mine] = np.arange(len(mine))
        here = local[row] >= 0
        bins = len(reference.words)
        at = np.searchsorted(reference.words, words[here])
        at[at == bins] = 0
        at = np.where(reference.words[at] == words[here], at, bins) if bins else at
        counts = np.bincount(local[row[here]] * (bins + 1) + at, minlength=len(mine) * (bins + 1))
        by_word[mine] = _distance(counts.reshape(-1, bins + 1), reference.shares)
    return classes.sum(axis=1), by_char, by_word, names != POOLED


def _given(langs: list, counts: pa.Array, totals: pa.Array) -> dict[str, Reference]:
    """The references that were joined to the rows."""
    found, first = {}, {}
    for i, name in enumerate(langs):
        first.setdefault(name, i)
    for name, i in first.items():
        if (pairs := counts[i].as_py()) is not None:
            kinds = [{p["key"]: p["n"] for p in pairs if p["kind"] == kind} for kind in (_KIND_CLASS, _KIND_WORD)]
            found[name] = Reference.of(*kinds, totals[i].as_py())
    return found


def measure(
    docs: DataFrame, known: References, text: str = "text", lang: str = "lang", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` (all, unless named) with the measures of each text."""
    share = docs.sparkSession.sparkContext.broadcast(known.large)
    columns = docs.columns
    if known.small is None:
        return _measured(docs, columns, share, text, lang, carry, False)
    inner = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    name = F.col(f"c{columns.index(lang)}").cast("string")
    large = F.coalesce(name.isin(*known.large), F.lit(True))
    joined = inner.where(~large).join(known.small, name == F.col("ref_lang"), "left").drop("ref_lang")
    return _measured(inner.where(large).toDF(*columns), columns, share, text, lang, carry, False).union(
        _measured(joined, columns, share, text, lang, carry, True))


def _measured(
    docs: DataFrame, columns: list[str], share: Broadcast, text: str, lang: str, carry: list[str] | None, joined: bool
) -> DataFrame:
    """Measures of ``docs`` with ``columns``, behind which the references stand if ``joined``."""
    kept = range(len(columns)) if carry is None else [columns.index(name) for name in carry]
    schema = T.StructType([*(T.StructField(columns[i], docs.schema.fields[i].dataType) for i in kept), *T.StructType.fromDDL(MEASURES).fields])
    at_text, at_lang = columns.index(text), columns.index(lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(at_lang).cast(pa.string())
            known = share.value
            if joined:
                known = known | _given(langs.to_pylist(), batch.column(len(columns)), batch.column(len(columns) + 1))
            for block in blocks(batch.column(at_text)):
                words, row, prefixes = _words(block)
                inside = _STARTS[block.data] & ~SPACES[block.data]
                part = batch.slice(block.first, block.rows)
                chars, by_char, by_word, own = _distances(
                    block, langs.slice(block.first, block.rows).to_pylist(), words, row, known)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept)] + [pa.array(x) for x in (
                        np.bincount(row, minlength=block.rows).astype(np.int64), _per_row(inside, block.offsets),
                        _per_row(_SYMBOLS[block.data], block.offsets),
                        _dup_lines(block, prefixes).astype(np.int64),
                        _repeat_words(words, row, block.rows).astype(np.int64), chars.astype(np.int64), by_char, by_word, own.astype(bool))],
                    names=[field.name for field in schema.fields],
                )

    return docs.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def diverges() -> Column:
    """Too far from the language, by its own reference and a histogram that is long enough to judge."""
    far = ((F.col("n_chars_all") >= MIN_CHARS) & (F.col("char_distance") > MAX_CHAR_DISTANCE)) | (
        (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE))
    return F.col("own_reference") & far


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that the base rules or the divergence reject."""
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = [f"c{docs.columns.index(name)}" for name in (text, lang)]
    measured = measure(inner, references(inner, *at), *at).where(~base_failed() & ~diverges())
    return measured.select(*inner.columns).toDF(*docs.columns)
