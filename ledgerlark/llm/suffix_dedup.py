"""Removal of byte strings that occur more than once, by a distributed suffix sort.

A byte goes if some ``LENGTH``-byte string that covers it also starts anywhere else, in
the same text or another. In terms of suffixes: two suffixes that share their first
``LENGTH`` bytes are neighbours in the suffix array. Sorting every suffix of the corpus
would move each byte ``LENGTH`` times, so only those that can have such a neighbour are
sorted:

1. Every window of ``LENGTH`` bytes is keyed by its smallest ``GRAM``-byte hash (leftmost
   on ties). Equal windows have equal keys. Windows in a row that share the key's place
   form one piece, of about 290 bytes; a piece is described by its key and a hash.
2. Pieces whose key occurs once hold no repeated window. Pieces that are equal as a whole
   are repeated as a whole, and one stands for all. What is left are single pieces whose
   key also occurs in other pieces: only there are suffixes compared.
3. These pieces are cut from their texts and range-partitioned by their leading bytes'
   key with sampled splitters. A key with more pieces than a bucket holds is cut into
   parts by the pieces' hash, which follow each other as buckets of their own.
4. Each bucket sorts the suffixes of its pieces by multikey quicksort, eight bytes at a
   time, and marks those equal to a neighbour over all ``LENGTH`` bytes.
5. The suffixes of keys that were cut go on in other buckets. They are compared across
   these by one aggregation.

Hashes are of 64 bits: pieces are equal if key and hash are, suffixes inside a bucket are
compared byte by byte, across buckets by key and hash.

Defined cases: a null or empty text has no bytes and nothing to remove; rows are told
apart by id and text, and repeated rows are repeats of each other; an empty table gives
no rows; further columns are ignored; a text of repeats only loses all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.blocks import Block, Prefixes, blocks, rows_of
from ledgerlark.sources.scratch import materialize

LENGTH = 200
GRAM = 24
SPREAD = LENGTH - GRAM + 1

BUCKET_BYTES = 2 << 20
PIECE_BYTES = LENGTH + SPREAD // 2

# A piece's place in one number: start (31 bits), windows less one (8), mark of the text (24).
_START, _EXTRA, _MARK = "shiftright(place, 32)", "shiftright(place, 24) & 255", "place & 16777215"

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The least value of every run of ``size``."""
    count = len(values)
    padded = np.full(-(-count // size) * size, _TOP)
    padded[:count] = values
    table = padded.reshape(-1, size)
    after = np.minimum.accumulate(table, axis=1).ravel()
    before = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:count - size + 1], after[size - 1:count])


def pieces_of(block: Block, hashed: bool = True) -> tuple[np.ndarray, ...]:
    """(row, start in the row, windows less one, key, hash) of every piece of a block."""
    if len(block.data) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    prefixes = Prefixes(block.data)
    grams = prefixes.grams(GRAM)
    place = _window_minima((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), SPREAD) & _LOW
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    edges = block.offsets[1:-1]
    new[edges[edges < len(place)]] = True
    # Windows that run over a row's end belong to no piece; whole pieces of them go.
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(place))
    row = rows_of(starts, block.offsets)
    stops = np.minimum(stops, block.offsets[row + 1] - LENGTH + 1)
    real = stops > starts
    starts, stops, row = starts[real], stops[real], row[real]
    keys = grams[place[starts].astype(np.int64)]
    content = prefixes.slices(starts, stops + LENGTH - 1) if hashed else keys
    return row, starts - block.offsets[row], stops - starts - 1, keys, content


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"),
        F.xxhash64(F.col(f"`{doc_id}`"), body).alias("rid"),
        (F.crc32(body.cast("binary")) % 16777216).alias("mark"))


def _keys(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                key = pieces_of(block, hashed=False)[3]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    return docs.select("text").mapInArrow(run, "key long")


def _pieces(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, mark = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for block in blocks(batch.column(0)):
                row, start, extra, key, content = pieces_of(block)
                row = row + block.first
                place = (start << 32) | (extra << 24) | mark[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (key.view(np.int64), content.view(np.int64), rid[row], place)],
                    names=["key", "content", "rid", "place"])

    return docs.select("text", "rid", F.col("mark").cast("long")).mapInArrow(
        run, "key long, content long, rid long, place long")


def _cut(asked: DataFrame) -> DataFrame:
    """The bytes of the asked pieces; rows of text, mark and the pieces asked of that text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asks, rids, marks = batch.column(1), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            offsets = asks.offsets.to_numpy()
            flat = asks.values
            key, part, place, copied, cut = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            for block in blocks(batch.column(0)):
                low, high = offsets[block.first], offsets[block.last]
                row = np.repeat(np.arange(block.rows), np.diff(offsets[block.first:block.last + 1]))
                fits = np.flatnonzero((place[low:high] & 0xFFFFFF) == marks[block.first + row])
                at, row = low + fits, row[fits]
                start, size = place[at] >> 32, ((place[at] >> 24) & 255) + LENGTH
                begin = block.offsets[row] + start
                ends = np.zeros(len(at) + 1, np.int64)
                np.cumsum(size, out=ends[1:])
                index = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin, size)
                body = pa.Array.from_buffers(
                    pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(block.data[index])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at]), pa.array(part[at]), pa.array(rids[block.first + row]), pa.array(place[at]),
                     pa.array(copied[at]), pa.array(cut[at]), body],
                    names=["key", "part", "rid", "place", "copied", "cut", "body"])

    schema = "key long, part long, rid long, place long, copied boolean, cut boolean, body binary"
    # The id goes along unused: the texts then have the same columns in both of their joins,
    # and their shuffle is made once.
    return asked.select("text", "asks", "rid", F.col("mark").cast("long"), "doc_id").mapInArrow(run, schema)


def multikey_order(data: np.ndarray, starts: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes by their first ``LENGTH`` bytes; also whether each equals the one before.

    Multikey quicksort over eight-byte characters: a level parts each open group by one
    character, and only groups of several suffixes stay open. A group of one mark
    (equal suffixes have equal marks) needs no parting and is compared once, at the end.
    """
    words = np.ndarray(max(len(data) - 7, 0), ">u8", data, strides=(1,))
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    spot = np.arange(len(starts))  # open suffixes, by their place in the order
    for level in range(LENGTH // 8):
        if not len(spot):
            break
        inside = order[spot]
        character = words[starts[inside] + 8 * level].astype(np.uint64)
        moved = np.lexsort((marks[inside], character, group[spot]))
        inside, character, old = inside[moved], character[moved], group[spot]  # groups are runs, so old is sorted
        order[spot] = inside
        new = np.ones(len(spot), bool)
        new[1:] = (old[1:] != old[:-1]) | (character[1:] != character[:-1])
        heads = np.flatnonzero(new)
        group[spot] = spot[heads[np.cumsum(new) - 1]]
        mark = marks[inside]
        differs = np.zeros(len(spot), bool)
        differs[1:] = ~new[1:] & (mark[1:] != mark[:-1])
        mixed = np.add.reduceat(differs, heads) > 0
        spot = spot[mixed[np.cumsum(new) - 1]]
    same = np.zeros(len(starts), bool)
    if len(starts) > 1:
        near = np.flatnonzero(marks[order[1:]] == marks[order[:-1]]) + 1
        left, right = starts[order[near - 1]], starts[order[near]]
        equal = np.ones(len(near), bool)
        for level in range(LENGTH // 8):
            equal &= words[left + 8 * level] == words[right + 8 * level]
        same[near] = equal
    return order, same


def _bucket(rows: pa.Table) -> pa.RecordBatch:
    """Repeated windows of single pieces, and what cut keys hold for other buckets."""
    rows = rows.combine_chunks()
    key, rid, place = (rows[name].to_numpy() for name in ("key", "rid", "place"))
    copied, cut = (rows[name].to_numpy(zero_copy_only=False) for name in ("copied", "cut"))
    body = rows["body"].combine_chunks() if isinstance(rows["body"], pa.ChunkedArray) else rows["body"]
    offsets = np.frombuffer(body.buffers()[1], np.int32)[body.offset:body.offset + len(body) + 1].astype(np.int64)
    data = np.frombuffer(body.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    count = np.diff(offsets) - LENGTH + 1
    owner = np.repeat(np.arange(len(key)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts = offsets[owner] + step
    marks = Prefixes(data).slices(starts, starts + LENGTH)
    # A window whose hash is met once cannot repeat inside the bucket.
    by_mark = np.argsort(marks, kind="stable")
    twin = np.zeros(len(marks), bool)
    same = marks[by_mark][1:] == marks[by_mark][:-1]
    twin[by_mark[1:][same]] = True
    twin[by_mark[:-1][same]] = True
    able = np.flatnonzero(twin)
    order, equal = multikey_order(data, starts[able], marks[able])
    repeated = np.zeros(len(marks), bool)
    repeated[able[order[equal]]] = True
    before = np.flatnonzero(equal) - 1
    repeated[able[order[before]]] = True
    first = place >> 32

    single = np.flatnonzero(repeated & ~copied[owner])
    new = np.ones(len(single), bool)
    new[1:] = (owner[single][1:] != owner[single][:-1]) | (step[single][1:] != step[single][:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(single))
    mine = owner[single[heads]]
    low = first[mine] + step[single[heads]]
    known = (rid[mine], low, np.ones(len(mine), bool), rid[mine], place[mine], low, low + tails - heads + LENGTH - 1)

    outer = np.flatnonzero(cut[owner])
    _, lead = np.unique(np.stack([key[owner[outer]].view(np.uint64), marks[outer]]), axis=1, return_index=True)
    outer = outer[lead]
    asks = ~(repeated[outer] | copied[owner[outer]])
    mine = owner[outer]
    low = np.where(asks, first[mine] + step[outer], -1)
    open_ = (key[mine], marks[outer].view(np.int64), np.zeros(len(outer), bool), rid[mine], place[mine], low, low + LENGTH)
    names = ["one", "two", "known", "rid", "place", "low", "high"]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(pair)) for pair in zip(known, open_)], names=names)


def _compare(pieces: DataFrame, buckets: int) -> DataFrame:
    """Repeated windows of the single pieces: rid, place, low, high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if parts and sum(part.num_rows for part in parts):
            yield _bucket(pa.Table.from_batches(parts))

    ranged = pieces.repartitionByRange(buckets, "key", "part")
    found = ranged.mapInArrow(run, "one long, two long, known boolean, rid long, place long, low long, high long")
    # Known runs have a group each; an open window is repeated if another bucket has it too.
    met = found.groupBy("known", "one", "two").agg(
        F.count("*").alias("met"), F.collect_list(F.struct("rid", "place", "low", "high")).alias("runs"))
    return met.where("known OR met > 1").select(F.inline("runs")).where("low >= 0")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per row of identified ``docs``: the byte spans covered by repeated strings, unmerged."""
    shared = _keys(docs).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = materialize(_pieces(docs).join(shared, "key", "left_semi"), "repeat-pieces")
    distinct = members.groupBy("key", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "place")).alias("one"))
    distinct = materialize(distinct, "repeat-distinct")
    mixed = distinct.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    parts = mixed.select("key", "kinds", F.expr(f"1 + kinds * {PIECE_BYTES} div {BUCKET_BYTES}").alias("parts"))
    size = parts.agg(F.sum("kinds")).first()[0] or 0
    buckets = max(1, -(-size * PIECE_BYTES // BUCKET_BYTES))
    asked = distinct.join(parts, "key").select(F.col("one.rid").alias("rid"), F.struct(
        "key", F.expr("pmod(content, parts)").alias("part"), "one.place", (F.col("n") > 1).alias("copied"),
        (F.col("parts") > 1).alias("cut")).alias("ask"))

    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.repartition(shuffles, "rid")
    asks = asked.groupBy("rid").agg(F.collect_list("ask").alias("asks"))
    single = _compare(_cut(texts.join(asks, "rid")), buckets).select("rid", "place", "low", "high")
    whole = members.join(distinct.where("n > 1").select("key", "content"), ["key", "content"], "left_semi").select(
        "rid", "place", F.expr(_START).alias("low"), F.expr(f"{_START} + ({_EXTRA}) + {LENGTH}").alias("high"))
    spans = single.unionByName(whole).select("rid", F.struct(F.expr(_MARK).alias("mark"), "low", "high").alias("span"))
    spans = spans.groupBy("rid").agg(F.collect_list("span").alias("spans"))
    return texts.join(spans, "rid", "left")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, the maximal removed ``spans`` and the ``kept`` bytes."""
    id_field = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, starts, ends, kept, counts = [], [], [], [], []
            marks = batch.column(2).to_numpy()
            for i, (body, spans) in enumerate(zip(batch.column(1), batch.column(3))):
                raw = memoryview(body.as_buffer())
                sizes.append(len(raw))
                if not spans.is_valid:
                    kept.append(bytes(raw))
                    counts.append(0)
                    continue
                mark, low, high = (spans.values.field(k).to_numpy() for k in range(3))
                mine = mark == marks[i]
                low, high = low[mine], high[mine]
                order = np.argsort(low)
                low, reach = low[order], np.maximum.accumulate(high[order])
                new = np.ones(len(low), bool)
                new[1:] = low[1:] > reach[:-1]
                heads = np.flatnonzero(new)
                low, high = low[heads].tolist(), reach[np.append(heads[1:], len(reach)) - 1].tolist()
                starts += low
                ends += high
                counts.append(len(low))
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *high], [*low, len(raw)])))
            offsets = np.zeros(len(counts) + 1, np.int32)
            np.cumsum(counts, out=offsets[1:])
            spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), spans),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    found = repeated_spans(_identified(docs, doc_id, text))
    return found.select("doc_id", "text", F.col("mark").cast("long"), "spans").mapInArrow(
        run, f"doc_id {id_field}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
