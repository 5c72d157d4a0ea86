"""Deletion of runs of lines that occurred before, found by winnowing. DataFrame functions only.

Texts are sequences of line hashes. Of every ``RUN`` lines in a row the least hash is
selected as a fingerprint, so any two runs of that length or more that are equal share
one. Fingerprints that stand at one place only need no more work. Matches are not extended
from place to place: every window of ``RUN`` lines is written with its fingerprint, and
windows under a fingerprint of several places are grouped by their lines. The fingerprint
only sifts and changes no row. Windows that are not the first of their group, in the order
of ids, overlap into runs, and the lines of these runs are deleted. The first occurrence stays.

Lines may be whole paragraphs, so a passage can be long and yet have fewer than ``RUN``
lines. With ``short_words`` every shorter run of that many words, or of ``SHORT_CHARS``
characters where words are not set apart, is a fingerprint of its own, and so is every
whole text of fewer than ``RUN`` lines, which meets whole texts only. ``without_repeats``
does this; ``dedup_lines`` does only if told to, because the SQL twin of its query knows
runs of ``RUN`` lines alone.

No group of places is paired with itself: a place meets only the first of its kind, and
that is a minimum, summed up before the shuffle.

Defined cases: a null text stays null and has no lines; an empty text is one blank line;
windows of blank lines only are never repeats; documents come in the order of id (nulls
last), then text hash; rows of the same id and text are one document and lose the same
lines; a text of repeats only becomes empty; texts shorter than a run stay as they are
unless ``short_words`` is given; an empty table gives no rows; further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import materialize

RUN = 3

# Least words, or characters, of a passage of fewer lines.
SHORT_WORDS = 50
SHORT_CHARS = 400


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _short_windows(docs: DataFrame, run: int, words: int) -> DataFrame:
    """Rows as of ``windows`` for the long passages of fewer than ``run`` lines and the short whole texts."""
    lined = docs.withColumn("lines", _lines(F.col("text"))).select(
        "doc_id", "rid", F.transform("lines", lambda line: F.struct(
            F.xxhash64(line).alias("hash"), line.rlike(r"\S").alias("filled"), F.length(line).alias("chars"),
            F.size(F.regexp_extract_all(line, F.lit(r"\S+"), F.lit(0))).alias("words"))).alias("lines"))

    def total(part: Column, name: str) -> Column:
        return F.aggregate(part[name], F.lit(0), lambda a, b: a + b)

    def row(part: Column, line: Column, size: Column, kind: Column) -> Column:
        key = F.xxhash64(kind, part["hash"])
        return F.struct(line.cast("int").alias("line"), size.cast("int").alias("size"), key.alias("print"), key.alias("window"),
                        F.lit(True).alias("selects"), F.exists(part["filled"], lambda x: x).alias("filled"),
                        ((total(part, "words") >= words) | (total(part, "chars") >= SHORT_CHARS)).alias("long"))

    def passages(size: int) -> DataFrame:
        at = F.sequence(F.lit(0), F.size("lines") - size)
        return lined.where(F.size("lines") >= size).select("doc_id", "rid", F.inline(F.transform(
            at, lambda i: row(F.slice("lines", i + 1, size), i, F.lit(size), F.lit(size))))).where("long")

    whole = lined.where((F.size("lines") > 0) & (F.size("lines") < run)).select(
        "doc_id", "rid", F.inline(F.array(row(F.col("lines"), F.lit(0), F.size("lines"), F.lit(0)))))
    for size in range(1, run):
        whole = whole.unionByName(passages(size))
    return whole.drop("long")


def windows(docs: DataFrame, run: int = RUN, short_words: int | None = None) -> DataFrame:
    """A written table with a row per window of ``run`` lines of (doc_id, rid, text): its first line and
    size, fingerprint, hash, and whether it is the first window to select that fingerprint."""
    hashed = docs.withColumn("lines", _lines(F.col("text"))).where(F.size("lines") >= run).select(
        "doc_id", "rid", F.transform("lines", lambda line: F.xxhash64(line)).alias("hashes"),
        F.transform("lines", lambda line: line.rlike(r"\S")).alias("filled"))
    last = F.size("hashes") - run
    hashed = hashed.withColumn("picks", F.transform(F.sequence(F.lit(0), last), lambda i: (
        i + F.array_position(F.slice("hashes", i + 1, run), F.array_min(F.slice("hashes", i + 1, run)))).cast("int")))
    rows = hashed.select("doc_id", "rid", F.inline(F.transform("picks", lambda pick, i: F.struct(
        i.alias("line"), F.lit(run).alias("size"),
        F.get("hashes", pick - 1).alias("print"),
        F.xxhash64(F.slice("hashes", i + 1, run)).alias("window"),
        ((i == 0) | (F.get("picks", F.greatest(i - 1, F.lit(0))) != pick)).alias("selects"),
        F.exists(F.slice("filled", i + 1, run), lambda x: x).alias("filled")))))
    if short_words is not None:
        rows = rows.unionByName(_short_windows(docs, run, short_words))
    return materialize(rows, "line-windows")


def repeated(found: DataFrame) -> DataFrame:
    """(rid, line, size) of every window that has the same lines as an earlier one."""
    shared = found.where("selects").groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    near = found.where("filled").join(shared, "print", "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "line")
    first = near.groupBy("print", "window").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    return near.join(first, ["print", "window"]).where(
        ~(F.col("rid").eqNullSafe(F.col("first.rid")) & (F.col("line") == F.col("first.line")))).select("rid", "line", "size")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN, short_words: int | None = None
) -> DataFrame:
    """``docs`` with repeated runs deleted from its text, and ``n_lines``, ``n_removed`` and
    ``n_runs`` behind its columns."""
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_at, text_at = (f"c{docs.columns.index(name)}" for name in (doc_id, text))
    marked = inner.withColumn("rid", F.xxhash64(id_at, text_at))
    texts = marked.select(F.col(id_at).alias("doc_id"), "rid", F.col(text_at).alias("text"))
    found = repeated(windows(texts, run, short_words))
    starts = found.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("line", "size"))).alias("starts"))
    joined = marked.join(starts, "rid", "left").withColumn("lines", _lines(F.col(text_at)))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s["line"], s["line"] + s["size"] - 1))))
    joined = joined.withColumn("gone", F.coalesce(gone, F.expr("array()").cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    body = F.when(F.size("gone") == 0, F.col(text_at)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    # A run begins where the line before a deleted one stays; deleted lines are in order.
    begins = F.filter("gone", lambda line, i: (i == 0) | (F.get("gone", F.greatest(i - 1, F.lit(0))) != line - 1))
    columns = [body.alias(name) if name == text_at else F.col(name) for name in inner.columns]
    return joined.select(
        *columns, F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"), F.size(begins).cast("long").alias("n_runs"),
    ).toDF(*docs.columns, "n_lines", "n_removed", "n_runs")


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN, short_words: int | None = SHORT_WORDS
) -> DataFrame:
    """``docs`` with repeated runs and long passages deleted; a document that loses all its lines goes."""
    found = dedup_lines(docs, doc_id, text, run, short_words).toDF(*(f"c{i}" for i in range(len(docs.columns) + 3)))
    count = len(docs.columns)
    return found.where(f"c{count + 1} < c{count} OR c{count} = 0").select(
        *(f"c{i}" for i in range(count))).toDF(*docs.columns)
