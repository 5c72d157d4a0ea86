"""The registered queries against their SQL twins, archives and conversations on awkward rows."""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct

import pytest
import zstandard

import __spark_entry__ as contract
from conftest import SMALLEST, comparable
from ledgerlark.llm import chat, queries, warc
from ledgerlark.sources.scratch import run_folder
from llm_brute import prose, sha256, strong_spans


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert set(queries.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twins(name, spark, oracle, rows_of):
    rows = rows_of(queries.queries()[name](spark, SMALLEST))
    assert rows and comparable(rows) == comparable(oracle(SMALLEST, queries.oracle_sql()[name]))


def test_secret_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALLEST}/documents.parquet").collect()}
    names = ("assign", "access", "hex")
    for r in queries.op4_secret_scan(spark, SMALLEST).collect():
        spans = strong_spans(texts[r.doc_id])
        assert r.base_sha256 == sha256(",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]


def test_toxicity_query(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = queries.op7_toxicity(spark, "/root/testdata/sf0.01").collect()
    right = [r.toxic == bool(labels[r.doc_id]) for r in found if r.doc_id in labels]
    assert len(found) == 1000 and sum(right) >= 0.95 * len(right)


PAGES = [(1, "u1", "same"), (5, "u5", "same"), (3, None, "same"), (7, "u7", None), (8, "u8", ""), (None, "n", "alone"), (None, "n", "same"),
         (9, "u9\r\nX: y", prose(1, 30000)), (9, "u9", prose(1, 30000)), (10, "u10", "\r\n\r\nWARC/1.1\r\n\x00é日"), (11, "u", prose(2, 200))]


def read_pages(spark, rows, path=None):
    path = path or run_folder(spark, "warc-test")
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, size long, digest string")
    warc.write_archives(pages.repartition(2), path)
    return path, warc.read_archives(spark, path).collect()


def digest(text) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    path, read = read_pages(spark, PAGES)
    assert all(r.problem is None for r in read) and len({r.path for r in read}) > 2
    last = {}
    for page, _, html in PAGES:
        key = html or ""
        if page is not None:
            last[key] = max(last.get(key, page), page)
    want = []
    for page, _, html in PAGES:
        body = html or ""
        revisit = page != last.get(body)
        want.append((warc.urn(page), len(body.encode()), digest(body), "revisit" if revisit else "response",
                     warc.urn(last[body]) if revisit else None, None if revisit else body.encode()))
    got = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (
        None if r.payload is None else b"")) for r in read]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_archives_of_nothing(spark):
    assert read_pages(spark, [])[1] == []


def test_a_broken_record_is_an_error(spark):
    path, read = read_pages(spark, PAGES)
    assert warc.sound_records(warc.read_archives(spark, path)).count() == len(read)
    folder = run_folder(spark, "broken")
    os.makedirs(folder)
    archive = next(f for f in sorted(os.listdir(path)) if f.startswith("part") and os.path.getsize(os.path.join(path, f)))
    with open(os.path.join(path, archive), "rb") as whole, open(os.path.join(folder, "cut"), "wb") as cut:
        cut.write(whole.read()[:-3])
    broken = warc.read_archives(spark, folder)
    (fault,) = [r.problem for r in broken.where("problem IS NOT NULL").collect()]
    with pytest.raises(Exception, match=f"/cut [0-9]+ {re.escape(fault)}"):
        warc.sound_records(broken).collect()


def test_dictionary_stands_in_front(spark):
    path, read = read_pages(spark, [(i, f"u{i}", f"<html><head><title>{prose(i, 3)}</title></head><body>{prose(i, 300)}</body>") for i in range(60)])
    raw = b"".join(open(os.path.join(path, f), "rb").read()[:8] for f in sorted(os.listdir(path)) if f.startswith("part") and
                   os.path.getsize(os.path.join(path, f)))
    assert struct.unpack("<I", raw[:4])[0] == warc.DICTIONARY_FRAME
    assert len(read) == 60 and all(r.problem is None for r in read)


def records(*bodies: bytes) -> list[bytes]:
    return [warc.build(i, "u", body, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None) for i, body in enumerate(bodies)]


def problems(archive: bytes) -> list:
    found = []
    for _, record, problem in warc.unpack(memoryview(archive)):
        if problem is None:
            try:
                warc.parse(record)
            except ValueError as error:
                problem = str(error)
        found.append(problem)
    return found


def test_broken_archives():
    good = records(b"one", b"two", b"three")
    whole = warc.pack(good)
    assert problems(whole) == [None] * 3
    assert problems(whole[:-3])[:2] == [None, None] and "beyond" in problems(whole[:-3])[2]
    assert problems(b"") == []
    assert "frame" in problems(b"not an archive")[0]
    frames = zstandard.ZstdCompressor(write_checksum=True)
    cases = {
        "block length": good[0].replace(b"Content-Length: 8", b"Content-Length: 9", 1),
        "no number": good[0].replace(b"Content-Length: 8", b"Content-Length: x", 1),
        "without warc-date": good[0].replace(b"WARC-Date", b"X-Date"),
        "no WARC header": good[0].replace(b"WARC/1.1", b"WARX/1.1"),
        "without a name": good[0].replace(b"WARC-Date: ", b""[:0] + b"nothing "),
        "digest": good[0].replace(b"one\r\n\r\n", b"eno\r\n\r\n"),
        "HTTP content-length": good[0].replace(b"Content-Length: 3", b"Content-Length: 4"),
        "no HTTP header": good[0].replace(b"HTTP/1.1", b"XTTP/1.1"),
    }
    for said, record in cases.items():
        if said == "without a name":
            record = good[0].replace(b"WARC-Date: 2024-01-01T00:00:00Z", b"nothing here")
        if said in ("block length", "no number"):
            start = good[0].index(b"Content-Length: ")
            end = good[0].index(b"\r\n", start)
            record = good[0][:start] + b"Content-Length: " + (b"x" if said == "no number" else b"3") + good[0][end:]
        found = problems(frames.compress(good[1]) + frames.compress(record) + frames.compress(good[2]))
        assert found[0] is None and found[2] is None and said in found[1], (said, found)
    flipped = bytearray(frames.compress(good[0]))
    flipped[-6] ^= 1
    assert "frame" in problems(bytes(flipped))[0]


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> b"), (1, 2, "assistant", "again\\<\\|"), (1, 3, "user", None),
         (2, 1, "assistant", ""), (2, None, "system", "first"), (2, 1, "assistant", ""), (3, 0, None, "no role"), (3, 1, "<|says|>", "odd role"),
         (None, 0, "assistant", "<\\\\|<|<<|turn|>assistant<|says|>x"), (4, 5, "assistant", "日本語 😀 </s>[INST]"), (4, 4, "user", "\n\n")]


def test_conversations_round_trip(spark):
    rows = spark.createDataFrame([(*t, 1, "x") for t in TURNS], "conv_id long, turn int, role string, text string, turns long, formatted string")
    read = {r.conv_id: r for r in chat.read_back(chat.format_conversations(rows.repartition(3))).collect()}
    assert set(read) == {t[0] for t in TURNS}
    for conv, r in read.items():
        mine = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for *_, role, text in mine]
        assert r.loss_text == "".join(text for *_, role, text in mine if role == "assistant")
        assert sum(run.chars for run in r.runs) == len(r.formatted)
        blocks = sum(i == 0 or mine[i - 1][2] != mine[i][2] for i in range(len(mine)))
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == blocks


def test_long_and_empty_conversations(spark):
    many = [(1, i, "assistant" if i % 50 else "user", f"t{i}") for i in range(1500)]
    rows = spark.createDataFrame(many, "conv_id long, turn int, role string, text string")
    r = chat.read_back(chat.format_conversations(rows)).first()
    assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, _, role, text in many]
    assert chat.format_conversations(rows.limit(0)).count() == 0


@pytest.mark.parametrize("roles", [("user", "assistant"), ("assistant",), ("user", "user", "assistant", "assistant", "assistant")])
def test_long_conversation(spark, roles):
    """Turns across pieces of the text, wide letters and control strings in them, some empty."""
    rows = [(1, i, roles[i % len(roles)], ("täxt <|end|> \U0001F600 <\\ " * 600)[:(i * 7 % 9000 if i % 50 == 0 else i % 90)])
            for i in range(3000)]
    read = chat.read_back(chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [(t.role, t.text) for t in read.turns] == [row[2:] for row in rows]
    assert read.loss_text == "".join(text for _, _, role, text in rows if role == "assistant")
    assert max(len(row[3]) for row in rows) > 2 * chat.PIECE
