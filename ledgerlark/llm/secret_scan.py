"""Secrets in texts, with weak candidates confirmed by the parts that belong to them.

A credential often comes in parts: an identifier, a secret, an endpoint. Strong forms
(``assign``, ``access``, ``hex``) are reported wherever they stand. Weak ones (a bare
mixed token ``key``, an identifier assignment ``ident``, an ``endpoint``) look like
ordinary text, so one is reported only if a complementary part stands in the same scope
(the lines between two blank lines) at most ``REACH`` code points away:

* a ``key`` needs an identifier (``access`` or ``ident``) or an ``endpoint``,
* an ``ident`` needs a secret (``assign``, ``hex`` or ``key``),
* an ``endpoint`` needs a secret.

A ``key`` may stand directly behind ``=`` or ``:``. The value that an ``ident`` has directly
behind its ``=`` belongs to the ``ident`` and is no ``key`` that could complete it.

Parts are linked by an interval join in bins of ``REACH`` code points: per scope, bin and
role only the first and the last part go into the join, because the nearest part of a
bin decides whether any lies within reach. So no group of parts is paired with itself,
however many parts a text has.

Defined cases: a null or empty text has no spans; rows are told apart by their id and
text, so repeated rows get equal results and one id with two texts two results; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 400

# Order of kinds that start at the same place; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
STRONG = 3

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENT = re.compile(
    r"""(?:client_?id|access_?key_?id|account_?id|tenant_?id|user_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""",
    re.I | re.A)
_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", re.A)
_ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._~:@-]+[^\s\"'<>]*|\b[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}\b", re.A)
_SCOPE_END = re.compile(r"\n[ \t]*\n")


def _mixed(token: str) -> bool:
    """Small and capital letters and digits, as random tokens have and words have not."""
    return any(map(str.isdigit, token)) and any(map(str.islower, token)) and any(map(str.isupper, token))


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every strong span and weak candidate, in code points."""
    found = [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span()) for m in _HEX.finditer(text)]
    strong = sorted((start, end) for _, start, end in found)
    weak = [(3, *m.span()) for m in _IDENT.finditer(text)]
    values = {end for _, _, end in weak}
    weak += [(4, *m.span()) for m in _KEY.finditer(text)
             if _mixed(m[0]) and not (text[m.start() - 1:m.start()] == "=" and len(m[0].rstrip("=")) + m.start() in values)]
    if ":" in text:
        weak += [(5, *m.span()) for m in _ENDPOINT.finditer(text)]
    taken = iter([*strong, (len(text) + 1, len(text) + 1)])
    begin, stop = next(taken)
    for kind, start, end in sorted(weak, key=lambda w: w[1]):
        while stop <= start:
            begin, stop = next(taken)
        if end <= begin:
            found.append((kind, start, end))
    return found


def find_parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span or candidate: the row's key, its scope, kind, start and end."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, mark, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                body = body.as_py()
                parts = parts_of(body) if body else []
                if parts:
                    ends = [m.start() for m in _SCOPE_END.finditer(body)]
                    scope = 0
                    for kind, start, end in sorted(parts, key=lambda p: p[1]):
                        while scope < len(ends) and ends[scope] < start:
                            scope += 1
                        rows.append((key, mark, scope, kind, start, end))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), types)],
                    names=["doc_id", "mark", "scope", "kind", "start", "end"])

    types = [pa.from_numpy_dtype("int64") if id_type == "bigint" else None, pa.int64(), *[pa.int32()] * 4]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _mark(text).alias("mark"), F.col(f"`{text}`")).mapInArrow(
        run, f"doc_id {id_type}, mark long, scope int, kind int, start int, end int")


def _mark(text: str) -> Column:
    return F.xxhash64(F.col(f"`{text}`"))


def link_parts(parts: DataFrame) -> DataFrame:
    """The parts to report: the strong ones, and weak ones near a part that completes them."""
    identifier, secret, endpoint = (F.col("kind").isin(*kinds) for kinds in ((1, 3), (0, 2, 4), (5,)))
    roles = F.when(identifier, "identifier").when(secret, "secret").when(endpoint, "endpoint")
    scope = ["doc_id", "mark", "scope"]
    bins = parts.groupBy(
        *(F.col(c).alias(f"_{c}") for c in scope), roles.alias("role"), F.floor(F.col("start") / REACH).alias("_bin")
    ).agg(F.min("start").alias("head"), F.max("start").alias("tail"))
    weak = parts.where(F.col("kind") >= STRONG).withColumn(
        "need", F.explode(F.when(F.col("kind") == 4, F.array(F.lit("identifier"), F.lit("endpoint")))
                          .otherwise(F.array(F.lit("secret"))))
    ).withColumn("bin", F.explode(F.expr(f"sequence(floor(start / {REACH}) - 1, floor(start / {REACH}) + 1)")))
    near = weak.join(
        bins,
        F.expr("doc_id <=> _doc_id AND mark <=> _mark") & (F.col("scope") == F.col("_scope")) & (F.col("bin") == F.col("_bin"))
        & (F.col("need") == F.col("role"))
        & ((F.abs(F.col("start") - F.col("head")) <= REACH) | (F.abs(F.col("start") - F.col("tail")) <= REACH)),
        "left_semi",
    )
    columns = ["doc_id", "mark", "kind", "start", "end"]
    return parts.where(F.col("kind") < STRONG).select(*columns).unionByName(near.select(*columns)).distinct()


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id and ``spans``, sorted by start and kind."""
    found = link_parts(find_parts(docs, doc_id, text)).groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    found = found.select(F.col("doc_id").alias("_doc_id"), F.col("mark").alias("_mark"), "spans")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _mark(text).alias("mark"))
    names = F.array(*map(F.lit, KINDS))
    return rows.join(found, F.expr("doc_id <=> _doc_id AND mark <=> _mark"), "left").select(
        "doc_id",
        F.coalesce(F.transform("spans", lambda s: F.struct(
            F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))),
            F.expr("array()")).cast("array<struct<kind:string,start:int,end:int>>").alias("spans"),
    )
