"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked token ids.

Each text is encoded by a byte-level BPE (A) and a piece BPE with byte fallback (B), and the
places where tokens of both end cut the tokens into groups. Inside a group every stretch
between neighbouring ends of either side lies in one A and one B token, so the stretches are
the links. Both encoders treat the parts of a text before a space that follows something
else than white space apart, and the groups never cross such a cut; so each distinct part is
encoded and aligned once per unit, a run of whole texts of a bounded size.

Counts of id pairs take two ways. A group of one token each whose ids are those of the
identity map (the B id with the same bytes as the A id) is counted in a vector as long as
A's vocabulary, one per task. Only the links of all other groups enter the shuffle of pairs,
each pair once per unit with its number, so that no frequent pair is a hot key; their counts
come back to the unit that asked. The best count of each B id and the counts of the identity
map are as long as the vocabularies and go to every task.

The files of the tokenizers are read on the driver and sent along, so only the driver needs
them. ``encoders`` refuses files for which the cut at spaces would not hold.

Defined cases: a null or empty text, and one whose tokens do not spell a space and the text
(as one with U+2581, which B reads as a space), has no tokens: zeros and an empty digest; it
takes no part in the counts; strings of special tokens are plain text; repeated rows are
counted each; a text longer than a unit is a unit of its own; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.blocks import blocks
from ledgerlark.llm.packing import narrow, pack, unpack
from ledgerlark.sources.scratch import materialize

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"

# Text in a unit: what a task holds at once.
UNIT_BYTES = 4 << 20

# Fixed value: the split of a byte-level BPE before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Before a space that does not follow white space, neither encoder joins anything.
CUT = re.compile(r"(?<=\S)(?= )")

_META = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Encoders:
    """Both encoders, the bytes of their tokens and the map from A ids to B ids of the same bytes."""

    a: tiktoken.Encoding
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_lengths: np.ndarray
    b_lengths: np.ndarray
    same: np.ndarray

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Tokens of parts that open with a space, and whether both sides spell the part.

        A takes all parts that end in no white space as one text and its tokens are cut at
        their ends, since it never joins anything across.
        """
        raw = [part.encode() for part in parts]
        whole = [i for i, part in enumerate(parts) if not part[-1].isspace()]
        ours: list[list[int]] = [[]] * len(parts)
        flat = self.a.encode_ordinary("".join([parts[i] for i in whole]))
        ends = np.cumsum(self.a_lengths[flat]) if flat else np.zeros(0, np.int64)
        cuts = [0, *(np.searchsorted(ends, np.cumsum([len(raw[i]) for i in whole])) + 1).tolist()]
        for i, low, high in zip(whole, cuts, cuts[1:]):
            ours[i] = flat[low:high]
        for i in set(range(len(parts))).difference(whole):
            ours[i] = self.a.encode_ordinary(parts[i])
        # B adds the first space itself, but not to an empty text.
        lone = [self.b.piece_to_id(_META)]
        theirs = [found or lone for found in self.b.encode([part[1:] for part in parts], num_threads=1)]
        sides = ((self.a_bytes, ours), (self.b_bytes, theirs))
        if all(b"".join([table[i] for tokens in lists for i in tokens]) == b"".join(raw) for table, lists in sides) and all(
                (_sums(lengths[flat], sizes) == [len(r) for r in raw]).all() for lengths, (flat, sizes) in
                ((self.a_lengths, _flat(ours)), (self.b_lengths, _flat(theirs)))):
            return ours, theirs, [True] * len(parts)
        spelled = [all(b"".join([table[i] for i in lists[k]]) == raw[k] for table, lists in sides) for k in range(len(parts))]
        return ours, theirs, spelled


@lru_cache(maxsize=2)
def encoders(a_file: bytes, b_file: bytes) -> Encoders:
    """The encoders of two files' contents."""
    spec, letters = json.loads(a_file), _byte_letters()
    model, before = spec["model"], spec["pre_tokenizer"]
    vocabulary = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ranks = [vocabulary[m] for m in merged]
    if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True) or ranks != sorted(ranks):
        raise ValueError("the first tokenizer is no plain byte-level BPE with ids in the order of its merges")
    a_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        a_bytes[number] = bytes(letters[x] for x in token)
    a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={raw: i for i, raw in enumerate(a_bytes) if raw}, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    if any(re.search(f"[^{_META}]{_META}", piece) for piece in pieces):
        raise ValueError("the second tokenizer has pieces across spaces")
    b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(piece)) else piece.replace(_META, " ").encode() for piece in pieces]
    by_bytes = {raw: i for i, raw in reversed(list(enumerate(b_bytes)))}
    # Of several B ids of the same bytes the piece counts, not the byte; others are irregular.
    by_bytes |= {raw: i for i, raw in enumerate(b_bytes) if not _BYTE.fullmatch(pieces[i])}
    same = np.array([by_bytes.get(raw, -1) for raw in a_bytes], np.int64)
    lengths = [np.fromiter(map(len, table), np.int64, len(table)) for table in (a_bytes, b_bytes)]
    return Encoders(a, b, a_bytes, b_bytes, *lengths, same)


@dataclass
class Aligned:
    """Links and groups of a list of parts; ``ends`` arrays cut the flat ones by part."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    regular: np.ndarray
    texts: list[str]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def align(ours: list[list[int]], theirs: list[list[int]], both: Encoders) -> Aligned:
    """Groups and links of every part. Laid end to end, parts end where tokens of both end."""
    (a, n_a), (b, n_b) = _flat(ours), _flat(theirs)
    a_end, b_end = np.cumsum(both.a_lengths[a]), np.cumsum(both.b_lengths[b])
    shared = np.intersect1d(a_end, b_end, assume_unique=True)
    ends = np.union1d(a_end, b_end)
    at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
    group_a, group_b, group = (np.searchsorted(shared, e) for e in (a_end, b_end, ends))
    single = (np.bincount(group_a, minlength=len(shared)) == 1) & (np.bincount(group_b, minlength=len(shared)) == 1)
    link_a, link_b = a[at_a], b[at_b]
    part_end = a_end[np.cumsum(n_a) - 1]
    part = np.searchsorted(part_end, ends)
    count = len(ours)
    n_links = np.bincount(part, minlength=count)
    n_groups = np.bincount(np.searchsorted(part_end, shared), minlength=count)
    return Aligned(n_a, n_b, n_groups, n_links, link_a, link_b, single[group] & (both.same[link_a] == link_b),
                   _group_texts(a, group_a, b, group_b, n_groups))


def _group_texts(a, group_a, b, group_b, n_groups) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for every part."""
    side = np.concatenate([np.zeros(len(a), np.int8), np.ones(len(b), np.int8)])
    group = np.concatenate([group_a, group_b])
    order = np.lexsort((side, group))
    side, group = side[order], group[order]
    last = np.ones(len(order), bool)
    last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
    marks = np.where(last, np.where(side == 0, "|", ";"), ",").tolist()
    words = list(map(str, np.concatenate([a, b])[order].tolist()))
    pieces = "".join(chain.from_iterable(zip(words, marks))).split(";")
    edges = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
    return [";".join(pieces[x:y]) for x, y in zip(edges, edges[1:])]


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = len(self)
        return self[key]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; an empty run gives 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _unit(texts: list[str], both: Encoders) -> tuple[bytes, bytes]:
    """What a unit knows of its texts, and what it must know to finish them."""
    number = _Numbers()
    rows = [np.fromiter(map(number.__getitem__, CUT.split(" " + text)), np.int64) if text and _META not in text
            else np.zeros(0, np.int64) for text in texts]
    ours, theirs, spelled = both.encode(list(number))
    wrong = ~np.array(spelled, bool)
    rows = [row if not wrong[row].any() else row[:0] for row in rows]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    parts = np.concatenate([*rows, np.zeros(0, np.int64)])
    # Parts that spell something else stay in the numbering, with a token that both have.
    either = int(np.argmax(both.same >= 0))
    for i in np.flatnonzero(wrong).tolist():
        ours[i], theirs[i] = [either], [int(both.same[either])]
    found = align(ours or [[either]], theirs or [[int(both.same[either])]], both)
    digest = [hashlib.sha256(";".join(map(found.texts.__getitem__, row.tolist())).encode()).hexdigest() if len(row) else "" for row in rows]
    times = np.repeat(np.bincount(parts, minlength=len(found.n_a)), found.n_links)
    key = found.link_a * len(both.b_bytes) + found.link_b
    odd = ~found.regular & (times > 0)
    pair, place = np.unique(key[odd], return_inverse=True)
    link = -1 - found.link_a  # a regular link is told by its A id, below zero
    link[odd] = place
    one = np.bincount(found.link_a[found.regular], weights=times[found.regular]).astype(np.int64)
    per_text = {name: narrow(_sums(getattr(found, name)[parts], sizes)) for name in ("n_a", "n_b", "n_groups", "n_links")}
    body = pack(**per_text, digest=digest, sizes=narrow(sizes), parts=narrow(parts), links=narrow(found.n_links), link=narrow(link))
    asks = pack(pair=pair, times=np.bincount(place, weights=times[odd], minlength=len(pair)).astype(np.int64),
                one=np.flatnonzero(one), one_times=one[one > 0])
    return body, asks


def _units(docs: DataFrame, files: Broadcast) -> DataFrame:
    """A row per unit; docs has an id and a text."""
    schema = T.StructType([
        T.StructField("unit", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[0].dataType)),
        T.StructField("body", T.BinaryType()), T.StructField("asks", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(*files.value)
        unit = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch.column(1), UNIT_BYTES):
                part = batch.slice(block.first, block.rows)
                body, asks = _unit([text or "" for text in part.column(1).to_pylist()], both)
                ids = pa.ListArray.from_arrays(pa.array([0, block.rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit]), ids, pa.array([body], pa.binary()), pa.array([asks], pa.binary())], names=schema.names)
                unit += 1

    return docs.mapInArrow(run, schema)


def _asked(units: DataFrame) -> DataFrame:
    """(unit, pos, key, n): the pairs of the irregular groups of each unit, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                asks = unpack(data)
                count = len(asks["pair"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, unit)), pa.array(np.arange(count, dtype=np.int32)), pa.array(asks["pair"]), pa.array(asks["times"])],
                    names=["unit", "pos", "key", "n"])

    return units.select("unit", "asks").mapInArrow(run, "unit long, pos int, key long, n long")


def _identity_counts(units: DataFrame, files: Broadcast) -> DataFrame:
    """(key, n) of the regular pairs: a vector as long as A's vocabulary in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(*files.value)
        counts = np.zeros(len(both.a_bytes), np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                asks = unpack(data)
                counts[asks["one"]] += asks["one_times"]
        used = np.flatnonzero(counts)
        key = used * len(both.b_bytes) + both.same[used]
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(counts[used], pa.int64())], names=["key", "n"])

    return units.select("asks").mapInArrow(run, "key long, n long")


def align_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str = f"{FOLDER}/{A_FILE}", b_path: str = f"{FOLDER}/{B_FILE}"
) -> DataFrame:
    """Per row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            contents.append(file.read())
    both, files = encoders(*contents), spark.sparkContext.broadcast(tuple(contents))
    inner = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    units = materialize(_units(inner, files), "token-units")
    asked = _asked(units)
    width = len(both.b_bytes)
    counts = materialize(
        asked.select("key", "n").unionByName(_identity_counts(units, files)).groupBy("key").agg(F.sum("n").alias("n")), "pair-counts")
    # One number per B id, and one per A id: as long as the vocabularies.
    best = np.zeros(width, np.int64)
    for b, n in counts.groupBy((F.col("key") % width).alias("b")).agg(F.max("n")).collect():
        best[b] = n
    mapped = np.flatnonzero(both.same >= 0)
    keys = spark.createDataFrame(pa.table({"key": pa.array(mapped * width + both.same[mapped], pa.int64())}))
    one = np.zeros(len(both.a_bytes), np.int64)
    for key, n in counts.join(F.broadcast(keys), "key", "left_semi").collect():
        one[key // width] = n
    # At most a row per unit and pair, so a frequent pair has no more rows than there are units.
    told = asked.join(counts.withColumnRenamed("n", "count"), "key").groupBy("unit").agg(
        F.sort_array(F.collect_list(F.struct("pos", "count"))).alias("told"))
    finished = _finished(units.join(told, "unit", "left"), docs.schema[doc_id].dataType, best, one, both.same, width)
    return finished.withColumnRenamed("id", doc_id)


def _finished(units: DataFrame, id_type: T.DataType, best: np.ndarray, one: np.ndarray, same: np.ndarray, width: int) -> DataFrame:
    """A row per text; ``told`` are the counts of the unit's pairs in their order."""
    share = units.sparkSession.sparkContext.broadcast((best, one, same))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(n, T.LongType()) for n in names), T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, one, same = share.value
        for batch in batches:
            for ids, body, asks, told in zip(*batch.columns):
                unit, pair = unpack(body.as_py()), unpack(asks.as_py())["pair"]
                sizes, parts, links, link = (unit[name] for name in ("sizes", "parts", "links", "link"))
                count = told.values.to_numpy() if told.is_valid else np.zeros(0, np.int64)
                regular = link < 0
                a = -1 - link[regular]
                number, top = np.zeros(len(link), np.int64), np.zeros(len(link), np.int64)
                number[regular], top[regular] = one[a], best[same[a]]
                if len(pair):
                    odd = ~regular
                    number[odd], top[odd] = count[link[odd]], best[pair[link[odd]] % width]
                by_part = [_sums(values, links) for values in ((number == top).astype(np.int64), number)]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, *(pa.array(unit[name], pa.int64()) for name in names[:4]),
                     *(pa.array(_sums(values[parts], sizes), pa.int64()) for values in by_part), pa.array(unit["digest"], pa.string())],
                    names=schema.names)

    return units.select("ids", "body", "asks", F.col("told.count").alias("count")).mapInArrow(run, schema)
