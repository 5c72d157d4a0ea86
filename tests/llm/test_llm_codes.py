"""Token alignment and vector codes against brute force."""

from __future__ import annotations

import math
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SMALLEST
from ledgerlark.llm import token_alignment, vector_codes
from ledgerlark.llm.packing import grow, pack, pack_keys, shrink, unpack, unpack_keys
from llm_brute import awkward_texts, prose, sha256


def test_packing_gives_back_what_it_took():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (unpack_keys(pack_keys(keys)) == keys).all()
    assert len(unpack_keys(pack_keys(keys[:0]))) == 0


@pytest.mark.parametrize("values", [
    [], [7], [5, 5, 5], [0, 255, 256, -1], [2 ** 62, -2 ** 62], [-2 ** 63, 2 ** 63 - 1], [2 ** 40, 2 ** 40 + 70_000], [True, False, True]])
def test_numbers_are_shrunk_and_grown(values):
    array = np.array(values, bool if values[:1] == [True] else np.int64)
    back = grow(shrink(x=array, keys=pack_keys(np.arange(3, dtype=np.uint64)), none=array[:0]))
    assert list(back) == ["x", "keys", "none"] and back["x"].tolist() == values and back["x"].dtype == array.dtype
    assert unpack_keys(back["keys"]).tolist() == [0, 1, 2] and len(back["none"]) == 0
    assert len(shrink(x=array)) < 120
    got = unpack(pack(a=np.arange(5), b=["x", ""], c=np.zeros(0, np.int32)))
    assert got["a"].tolist() == list(range(5)) and got["b"].tolist() == ["x", ""] and len(got["c"]) == 0
    assert unpack(None) == {}


class Reader:
    """Both tokenizers over whole texts, by their own libraries."""

    def __init__(self):
        folder = token_alignment.FOLDER
        self.a = Tokenizer.from_file(f"{folder}/{token_alignment.A_FILE}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{token_alignment.B_FILE}")
        letters = token_alignment._byte_letters()
        self.a_bytes = {i: bytes(letters[x] for x in t) for t, i in self.a.get_vocab().items() if all(x in letters for x in t)}

    def b_raw(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        found = token_alignment._BYTE.fullmatch(piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()

    def tokens(self, text: str | None):
        if not text:
            return [], [], [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text, num_threads=1)
        raw_a, raw_b = [self.a_bytes[i] for i in a], [self.b_raw(i) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return [], [], [], []
        return a, b, list(accumulate(map(len, raw_a))), list(accumulate(map(len, raw_b)))


def aligned(texts: list[str | None]) -> list[tuple]:
    """The contract's columns, link by link."""
    reader, rows, counts = Reader(), [], Counter()
    for text in texts:
        a, b, end_a, end_b = reader.tokens(text)
        links = []
        for i, x in enumerate(a):
            low, high = (end_a[i - 1] if i else 0), end_a[i]
            links += [(x, y) for j, y in enumerate(b) if (end_b[j - 1] if j else 0) < high and low < end_b[j]]
        cuts = sorted(set(end_a) & set(end_b))
        groups = [f"{','.join(str(x) for x, e in zip(a, end_a) if low < e <= high)}|{','.join(str(y) for y, e in zip(b, end_b) if low < e <= high)}"
                  for low, high in zip([0, *cuts], cuts)]
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, sha256(";".join(groups)) if groups else ""))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, n_groups, len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), digest)
            for n_a, n_b, n_groups, links, digest in rows]


TEXTS = ["a", " a", "  a  b ", "x\n  y", "tab\t tab\n\n  end\n", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", " ", "   ", "　 x", "a\x85 b",
         "日本語 の テキスト", "😀😀 😀", "don't we'll I'M", "\x00\x1c \x1f z", "naïve café", "1234567 89", "a" * 3000, " " * 3000 + "b", "é x"]


@pytest.mark.parametrize("unit", [token_alignment.UNIT_BYTES, 500])
def test_alignment(spark, monkeypatch, unit):
    monkeypatch.setattr(token_alignment, "UNIT_BYTES", unit)
    texts = [t if t is None or len(t) < 5000 else t[:5000] for t in [*TEXTS, *[t for _, t in awkward_texts()], prose(5, 60), prose(5, 60)]]
    rows = [(i if i != 4 else None, t, 1, 2, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, unit long, pos int, key string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align_texts(docs).collect()}
    want = aligned(texts)
    assert {i: got[i if i != 4 else None] for i in range(len(texts))} == dict(enumerate(want))
    assert any(w[0] for w in want) and any(not w[0] for w in want)


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet").where("length(text) < 3000").limit(60).cache()
    rows = docs.collect()
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align_texts(docs).collect()}
    assert got == dict(zip([r.doc_id for r in rows], aligned([r.text for r in rows])))


def test_alignment_of_nothing(spark):
    assert token_alignment.align_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = token_alignment.align_texts(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_files_that_do_not_fit_are_refused():
    folder = token_alignment.FOLDER
    files = [open(f"{folder}/{name}", "rb").read() for name in ("word_bpe_49k.json", token_alignment.B_FILE)]
    with pytest.raises(ValueError):
        token_alignment.encoders(*files)


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 5), st.integers(1, 40), st.data())
def test_products_are_exact(width, bits, data):
    number = st.integers(-(1 << bits), 1 << bits)
    rows = [data.draw(st.lists(number, min_size=width, max_size=width)) for _ in range(7)]
    entries = rows[:3] + [rows[0]]
    gaps = [[sum((x - c) ** 2 for x, c in zip(row, entry)) for entry in entries] for row in rows]
    best, error = vector_codes.nearest(np.array(rows, np.int64), np.array(entries, np.int64))
    assert best.tolist() == [gap.index(min(gap)) for gap in gaps]
    assert [int(e) for e in error] == [min(gap) for gap in gaps]


def coded(rows: list[tuple]) -> list[tuple]:
    """The contract's columns in Python's whole numbers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // 8)
    whole = [[math.floor(int(x) * 4096 if abs(x) >= 2 ** 53 else x * 4096) for x in v] + [0] * (8 * width - len(v)) for _, v, _ in kept]
    parts = [[v[p * width:(p + 1) * width] for p in range(8)] for v in whole]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:16]
    books = [[parts[k][p] for k in first] for p in range(8)]

    def assigned(p):
        gaps = [[sum((x - c) ** 2 for x, c in zip(row[p], entry)) for entry in books[p]] for row in parts]
        return [(gap.index(min(gap)), min(gap)) for gap in gaps]

    for _ in range(6):
        for p in range(8):
            code = [c for c, _ in assigned(p)]
            for e in set(code):
                own = [row[p] for row, c in zip(parts, code) if c == e]
                books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    final = [assigned(p) for p in range(8)]
    codes = ["".join(f"{final[p][k][0]:02x}" for p in range(8)) for k in range(len(kept))]
    errors = [sum(final[p][k][1] for p in range(8)) for k in range(len(kept))]
    digest = sha256(",".join(str(x) for p in range(8) for entry in books[p] for x in entry))
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label.setdefault(label, []).append(e)
    long = lambda x: x if x < 1 << 63 else None
    return [(i, code, long(e), long(sum(by_label[label])) if all(map(long, by_label[label])) or 0 in by_label[label] else None, digest)
            for (i, _, label), code, e in zip(kept, codes, errors)]


def codes_of(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, label int, n long, group string, vector int")
    return vector_codes.compress(table.repartition(3)).collect()


def comparable_codes(rows):
    return sorted(map(repr, map(tuple, rows)))


def vectors(seed: int, count: int, width: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=width).round(3).tolist(), int(i) % 3) for i in rng.permutation(count)]


def test_codes(spark):
    rows = vectors(1, 70, 16)
    awkward = [(100, None, 1), (101, [math.nan] * 16, 1), (102, [math.inf] + [0.0] * 15, 1), (103, [None] + [0.0] * 15, 1),
               (None, rows[0][1], None), (5, rows[1][1], None), *[(104, rows[2][1], 2)] * 5, (105, [], 1), (106, [1.0, -2.0, 3.0], 1)]
    assert comparable_codes(codes_of(spark, rows + awkward)) == comparable_codes(coded(rows + awkward))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)], vectors(2, 5, 8), vectors(3, 20, 12)], ids=len)
def test_codes_of_little(spark, rows):
    assert comparable_codes(codes_of(spark, rows)) == comparable_codes(coded(rows))


@pytest.mark.parametrize("scale", [1e4, 1e6, 1e12, 1e30])
def test_codes_of_large_numbers(spark, scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in vectors(4, 40, 16)]
    assert comparable_codes(codes_of(spark, rows)) == comparable_codes(coded(rows))
