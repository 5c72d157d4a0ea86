"""Near-duplicate groups by MinHash bands, odd sketches and full shingle sets.

1. Each text gives the set of its word shingles; texts with equal sets are one class and
   stand for one another from here on. A class has MinHash samples, of which every four
   make a band, and two parity bitmaps: an odd sketch, into which the samples are folded
   (each flips one bit), and the parity of the whole set, with four to eight bits a shingle.
2. Classes that share a band are candidates. The number of differing bits of two odd
   sketches estimates their similarity; that of two set parities is at most the size of
   the sets' symmetric difference, so it rules pairs out for certain.
3. Pairs are not formed inside a band's bucket where a chain does: each bucket has a head
   (another one in each band), and first all members meet their heads. Only members that
   are then still in different components meet one another.
4. What the sketches leave is confirmed on the full sets, best pairs first, until no
   unconfirmed pair joins two components. Components that the sketches had joined and the
   full sets did not are looked at once more in the same way.

Similar pairs are missed only if all ``BANDS`` bands differ: at a similarity of exactly
0.8 once in 300,000 pairs, and less often above.

Defined cases: a null or empty text has an empty set and is linked with nothing; repeated
rows are copies of each other; a null id is larger than every other; an empty table gives
no rows; further columns are ignored, and kept by the removal, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.blocks import LOWER, SPACES, Block, Prefixes, blocks, mix, rows_of, sequence_hash, string_list, word_bounds
from ledgerlark.llm.components import components, merged
from ledgerlark.operators.joins import join_to_summary
from ledgerlark.sources.scratch import materialize, materialize_counted, release

SHINGLE = 5
SIMILARITY = (80, 100)

BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
_FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)

# Bits of the odd sketch, and the most that may differ: at a similarity of 0.8 the
# differing samples are more than that only beyond six standard deviations.
ODD_BITS = 256
ODD_MOST = 63

# Members of a bucket that meet in one task, and pairs that are sifted at once.
MEET = 2048
SIFT = 50_000


def shingles_of(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by row and hash."""
    data = LOWER[block.data]
    starts, ends = word_bounds(data, block.offsets, SPACES)
    words, row = Prefixes(data).slices(starts, ends), rows_of(starts, block.offsets)
    counts = np.bincount(row, minlength=block.rows)
    made, rows = [sequence_hash(words, size)], [row[:max(len(row) - size + 1, 0)]]
    whole = rows[0] == row[size - 1:]
    made[0], rows[0] = made[0][whole], rows[0][whole]
    begin = np.cumsum(counts) - counts
    for short in range(1, size):
        mine = np.flatnonzero(counts == short)
        if len(mine):
            total = np.zeros(len(mine), np.uint64)
            for i in range(short):
                total = mix(total + words[begin[mine] + i])
            made.append(mix(total + np.uint64(short)))
            rows.append(mine)
    made, rows = np.concatenate(made), np.concatenate(rows)
    order = np.lexsort((made, rows))
    made, rows = made[order], rows[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], made[new]


def level_of(size: np.ndarray) -> np.ndarray:
    """Logarithm of the bits of a set's parity: four times its size or more, 64 at least."""
    return np.maximum(6, np.ceil(np.log2(np.maximum(4 * size, 1)))).astype(np.int64)


def _odd_sketches(samples: np.ndarray) -> np.ndarray:
    """The parity of each row's samples, as bytes."""
    bit = mix(samples + _FACTORS[None, :]) % np.uint64(ODD_BITS)
    flat = (np.arange(len(samples))[:, None] * ODD_BITS + bit.astype(np.int64)).ravel()
    parity = np.bincount(flat, minlength=len(samples) * ODD_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(-1, ODD_BITS), axis=1, bitorder="little")


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def sketch(marked: DataFrame, shingle: int) -> DataFrame:
    """doc_id, rid, n, and of the set: c1, c2 (its hash), bands, odd sketch and parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                row, key = shingles_of(block, shingle)
                n = np.bincount(row, minlength=block.rows)
                begin = np.cumsum(n) - n
                full = np.flatnonzero(n)
                samples = np.zeros((len(full), SAMPLES), np.uint64)
                if len(full):
                    for k in range(SAMPLES):
                        samples[:, k] = np.minimum.reduceat((key * _FACTORS[k]) >> np.uint64(32), begin[full])
                bands = np.zeros((block.rows, BANDS), np.uint64)
                total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS))
                for k in range(ROWS):
                    total = mix(total + samples[:, k::ROWS])
                bands[full] = total
                odd = np.zeros((block.rows, ODD_BITS // 8), np.uint8)
                odd[full] = _odd_sketches(samples)
                c = np.zeros((2, block.rows), np.uint64)
                if len(full):
                    for i in range(2):
                        c[i, full] = mix(np.add.reduceat(mix(key + np.uint64(i)), begin[full]) + n[full].astype(np.uint64))
                width = np.left_shift(1, level_of(n))
                place = np.cumsum(width) - width
                parity = np.bincount(place[row] + (key % width[row].astype(np.uint64)).astype(np.int64), minlength=width.sum()) & 1
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(c[0].view(np.int64)),
                     pa.array(c[1].view(np.int64)),
                     string_list(bands.view(np.int64).ravel(), np.full(block.rows, BANDS), pa.int64()),
                     _binary(odd, np.full(block.rows, ODD_BITS // 8)),
                     _binary(np.packbits(parity.astype(np.uint8), bitorder="little"), width // 8)],
                    names=["doc_id", "rid", "n", "c1", "c2", "bands", "odd", "parity"])

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(
        run, f"doc_id {kind}, rid long, n long, c1 long, c2 long, bands array<long>, odd binary, parity binary")


def _matrix(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    """The binaries of some rows, all of ``width`` bytes, as words."""
    if not len(rows):
        return np.zeros((0, width // 8), np.uint64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[rows].astype(np.int64)[:, None] + np.arange(width)].view(np.uint64)


def differing(left: pa.Array, right: pa.Array, i: np.ndarray, j: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Differing parity bits of the sets left[i] and right[j], of n and m shingles; the larger
    bitmap is folded to the size of the smaller, which keeps the bound."""
    out = np.zeros(len(i), np.int64)
    at, to = level_of(n), level_of(m)
    for a, b in np.unique(np.stack([at, to]), axis=1).T if len(i) else ():
        mine = np.flatnonzero((at == a) & (to == b))
        one, two = _matrix(left, i[mine], 1 << a >> 3), _matrix(right, j[mine], 1 << b >> 3)
        while one.shape[1] > two.shape[1]:
            one = one[:, :one.shape[1] // 2] ^ one[:, one.shape[1] // 2:]
        while two.shape[1] > one.shape[1]:
            two = two[:, :two.shape[1] // 2] ^ two[:, two.shape[1] // 2:]
        out[mine] = np.bitwise_count(one ^ two).sum(axis=1)
    return out


def _able(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sets of these sizes can be similar enough."""
    part, whole = SIMILARITY
    return whole * np.minimum(n, m) >= part * np.maximum(n, m)


def _sifted(left, right, i, j, n, m) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs the sketches leave, and the share of differing bits of those."""
    pick = np.flatnonzero(_able(n, m))
    odd = np.bitwise_count(_matrix(left[0], i[pick], ODD_BITS // 8) ^ _matrix(right[0], j[pick], ODD_BITS // 8)).sum(axis=1)
    pick = pick[odd <= ODD_MOST]
    bits = differing(left[1], right[1], i[pick], j[pick], n[pick], m[pick])
    part, whole = SIMILARITY
    total = n[pick] + m[pick]
    # |A ^ B| is (1 - s) / (1 + s) of |A| + |B| at a similarity of s, and less above.
    fits = (whole + part) * bits <= (whole - part) * total
    return pick[fits], bits[fits] / total[fits]


def _sift_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b, far) of the pairs that the sketches leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.arange(batch.num_rows)
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            pick, far = _sifted(batch.columns[4:6], batch.columns[6:8], rows, rows, n, m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(pick)), batch.column(1).take(pa.array(pick)), pa.array(far)], names=["a", "b", "far"])

    return pairs.select("a", "b", "n_a", "n_b", "odd_a", "parity_a", "odd_b", "parity_b").mapInArrow(run, "a long, b long, far double")


def _meet(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, far) of sifted pairs of different components in the same bucket.

    A bucket of many members is dealt out in parts, and every two parts meet in one task.
    """
    sizes = members.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    parts = join_to_summary(members, sizes.withColumn("parts", F.expr(f"(size + {MEET - 1}) div {MEET}")), "bucket", "size")
    parts = parts.join(classes.select("node", "n", "odd", "parity", "bands"), "node")
    parts = parts.withColumn("mine", F.expr("pmod(xxhash64(node), parts)")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    parts = parts.select(
        "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node", "comp",
        "n", "odd", "parity", "bands")

    def pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        group = np.stack([rows.column(k).to_numpy() for k in range(3)])
        node, comp, n = (rows.column(k).to_numpy() for k in (3, 4, 5))
        new = np.ones(len(node), bool)
        new[1:] = (group[:, 1:] != group[:, :-1]).any(axis=0)
        label = np.cumsum(new)
        sketches = rows.columns[6:8]
        bands = rows.column(8).flatten().to_numpy().reshape(len(node), BANDS)
        lefts, rights, count = [], [], 0
        steps = int(np.bincount(label).max(initial=0))
        for step in range(1, steps):
            i = np.flatnonzero((label[step:] == label[:-step]) & (comp[step:] != comp[:-step]))
            lefts.append(i)
            rights.append(i + step)
            count += len(i)
            if count < SIFT and step < steps - 1:
                continue
            i, j = np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, count = [], [], 0
            pick, far = _sifted(sketches, sketches, i, j, n[i], n[j])
            # A pair counts in the first of the buckets that it shares.
            one, two = bands[i[pick]], bands[j[pick]]
            first = one[np.arange(len(pick)), (one == two).argmax(axis=1)] == group[0, i[pick]]
            pick, far = pick[first], far[first]
            if len(pick):
                a, b = node[i[pick]], node[j[pick]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(far)], names=["a", "b", "far"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by bucket and part; a bucket's part may go on in the next batch.
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            group = np.stack([batch.column(k).to_numpy() for k in range(3)])
            last = int(np.flatnonzero((group != group[:, -1:]).any(axis=0)).max(initial=-1)) + 1
            yield from pairs(_own(batch.slice(0, last)))
            rest = _own(batch.slice(last))
        if rest is not None:
            yield from pairs(rest)

    dealt = parts.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return dealt.mapInArrow(run, "a long, b long, far double").groupBy("a", "b").agg(F.min("far").alias("far"))


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch without the rows around a slice of it."""
    return batch.take(pa.array(np.arange(batch.num_rows)))


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b, linked) by the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (column.cast(pa.large_string()) for column in batch.columns[2:4])
            for block in blocks(left):
                part = right.slice(block.first, block.rows)
                row, key = shingles_of(block, shingle)
                rows, keys = [row], [key]
                for other in blocks(part):
                    found = shingles_of(other, shingle)
                    rows.append(found[0] + other.first)
                    keys.append(found[1])
                n = np.bincount(row, minlength=block.rows)
                m = np.bincount(np.concatenate(rows[1:]), minlength=block.rows)
                row, key = np.concatenate(rows), np.concatenate(keys)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (key[1:] == key[:-1])], minlength=block.rows)
                share, whole = SIMILARITY
                mine = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [mine.column(0), mine.column(1), pa.array(whole * both >= share * (n + m - both))], names=["a", "b", "linked"])

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def _with_comps(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """``pairs`` with the components of both ends; a node without a label is its own."""
    for end in "ab":
        pairs = pairs.join(comps.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}")), end, "left")
        pairs = pairs.withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    return pairs


def _confirmed(
    candidates: DataFrame, texts: DataFrame, comps: DataFrame | None, shingle: int, choices: tuple[str, ...]
) -> DataFrame:
    """The components after confirming candidates until none is left that joins two.

    At first each "class" meets the best of the others, then each two "component"s their
    best pair, and then "all" that is left.
    """
    left = candidates
    for choice in choices:
        if comps is not None:
            left, open_pairs = materialize_counted(
                _with_comps(left.select("a", "b", "far"), comps).where("comp_a <> comp_b"), "near-left")
            if not open_pairs:
                break
        if choice == "class":
            pick = left.groupBy("a").agg(F.min(F.struct("far", "b")).alias("best")).select("a", "best.b")
        elif choice == "component":
            pick = left.groupBy(F.least("comp_a", "comp_b").alias("x"), F.greatest("comp_a", "comp_b").alias("y")).agg(
                F.min(F.struct("far", "a", "b")).alias("best")).select("best.a", "best.b")
        else:
            pick = left.select("a", "b")
        tested = materialize(_confirm(pick, texts, shingle), "near-tested")
        found = tested.where("linked").select("a", "b")
        comps = components(found) if comps is None else merged(comps, found)
        left = left.select("a", "b", "far").join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return comps


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), body).alias("rid"), body.alias("text"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, rid (hash of id and text), n (distinct shingles), component (null without
    shingles), and first_id and first_rid of the component's row of the smallest id."""
    marked = _marked(docs, doc_id, text)
    sketched = materialize(sketch(marked, shingle), "near-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    classes = sketched.where("n > 0").groupBy("c1", "c2").agg(
        F.min("rid").alias("rid"), first.alias("first"), *(F.first(c).alias(c) for c in ("n", "bands", "odd", "parity")))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    def side(end: str) -> DataFrame:
        return classes.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in ("n", "odd", "parity")))

    # The bucket's bits shuffle the numbers of its nodes, so its head is as good as drawn.
    banded = classes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min(F.col("node").bitwiseXOR(F.col("bucket"))).alias("least")).where("size > 1")
    members = materialize(join_to_summary(banded, shared, "bucket", "size").select(
        "bucket", "node", F.col("least").bitwiseXOR(F.col("bucket")).alias("head")), "near-members")
    stars = members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).repartition("a").distinct()
    stars = materialize(_sift_pairs(stars.join(side("a"), "a").join(side("b"), "b")), "near-stars")

    def owned(comps: DataFrame, nodes: DataFrame) -> DataFrame:
        return nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    release(docs.sparkSession)
    guessed = components(stars)
    candidates = materialize(stars.unionByName(_meet(owned(guessed, members.select("bucket", "node")), classes)), "near-candidates")
    ends = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    needed = ends.join(classes.select("node", "rid"), "node")
    release(docs.sparkSession)
    texts = marked.select("rid", "text").join(needed, "rid").groupBy("rid").agg(
        F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")
    texts = materialize(texts, "near-texts")
    comps = _confirmed(candidates, texts, None, shingle, ("class", "component", "all"))
    # Inside what the stars had joined no other pairs were formed: where the full sets part it, form them.
    parted = owned(comps, guessed.select("node", F.col("comp").alias("guess"))).groupBy("guess").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    inside, inside_rows = materialize_counted(guessed.join(parted.select(F.col("guess").alias("comp")), "comp", "left_semi").select("node"), "near-parted")
    if inside_rows:
        again = owned(comps, members.select("bucket", "node").join(inside, "node", "left_semi"))
        more = materialize(_meet(again, classes).join(candidates.select("a", "b"), ["a", "b"], "left_anti"), "near-again")
        comps = _confirmed(more, texts, comps, shingle, ("component", "all"))
    labelled = owned(comps, classes.select("c1", "c2", "node", "first"))
    best = labelled.groupBy("comp").agg(F.min("first").alias("first"))
    labelled = labelled.drop("first").join(best, "comp").select(
        "c1", "c2", F.col("comp").alias("component"), F.col("first.doc_id").alias("first_id"), F.col("first.rid").alias("first_rid"))
    named = sketched.select("doc_id", "rid", "n", "c1", "c2")
    return named.where("n > 0").join(labelled, ["c1", "c2"]).drop("c1", "c2").unionByName(
        named.where("n = 0").drop("c1", "c2"), allowMissingColumns=True)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest id; rows without shingles stay."""
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_at, text_at = (f"c{docs.columns.index(name)}" for name in (doc_id, text))
    found = groups(inner, id_at, text_at, shingle).where("n = 0 OR rid = first_rid").groupBy("rid").agg(
        F.min("n").alias("n"))
    rid = F.xxhash64(F.col(id_at), F.coalesce(F.col(text_at).cast("string"), F.lit("")))
    kept = inner.withColumn("rid", rid).join(found, "rid")
    copy = F.row_number().over(Window.partitionBy("rid").orderBy("rid"))
    return kept.withColumn("copy", copy).where("n = 0 OR copy = 1").select(*inner.columns).toDF(*docs.columns)
