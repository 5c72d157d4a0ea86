"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents are shuffled (by a hash, so reruns agree) and laid end to end,
once per epoch; that stream of words is cut into equal blocks. A schedule of slots says
which source comes next: slot i is the point i * phi modulo 1 of the golden ratio
sequence, mapped through the sources' cumulative shares. The k-th slot of a source takes
its k-th block, so any stretch of the schedule holds the sources nearly in proportion.
A source's blocks together are its target, to the word.

Targets: sources in code point order, null last, weigh ``WEIGHTS`` in turn and share
``SHARE`` of all words; a target stops at ``EPOCHS`` times its source's words, and what
is over is shared again by weight until none is above. In closed form a target is
min(cap, level * weight), with the level read from the sources sorted by cap / weight.

Nothing here depends on one task holding a source: positions are prefix sums in two
levels (hash buckets inside a source, then rows inside a bucket), and slot ranks are
prefix sums over stretches of the schedule. Only the table of sources, a row per source,
is ordered as a whole.

Defined cases: a null or empty text has no words and is never taken; a null source is a
source of its own; repeated rows are each laid out for themselves; a null id is an id;
an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlark.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BLOCK_WORDS = 1024

# The golden ratio sequence in whole numbers: round(2^31 / phi), coprime to 2^31.
RING = 1 << 31
STEP = 1327217885

CELLS = 1024
STRETCH = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A written table of row number, id, source, its non-null key and the words of each row."""
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.when(F.col(f"`{source}`").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(f"`{source}`"))).alias("key"),
        word_count(F.col(f"`{text}`")).alias("size"),
    ), "mix-sizes")


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: key, words, target and the part of the ring of slots that is its own."""
    summed = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*map(F.lit, WEIGHTS))
    weighed = summed.withColumn("rank", rank).withColumn(
        "weight", F.get(weights, F.col("rank") % len(WEIGHTS)).cast("double"))
    cap = EPOCHS * F.col("source_size").cast("double")
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    levels = weighed.withColumn("cap", cap).withColumns({
        "spent": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "weights": F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)),
        "total": SHARE * F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    }).withColumn("level", (F.col("total") - F.col("spent")) / F.col("weights"))
    everywhere = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))
                  ).over(everywhere)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    made = levels.withColumn("target", target)
    before = W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    share = F.sum("target").over(everywhere)
    end = F.when(share > 0, F.round(F.sum("target").over(before) / share * RING)).otherwise(0).cast("long")
    made = made.withColumn("high", end)
    return made.withColumn("low", F.lag("high", 1, 0).over(W.orderBy("rank"))).withColumn(
        "words", F.floor("target")).select("key", "source", "rank", "source_size", "target", "words", "low", "high")


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, key, k): slot by slot, which source comes and its how-manieth slot that is."""
    total = goals.agg(F.sum("words")).first()[0] or 0
    slots = goals.sparkSession.range(-(-total // block_words)).withColumnRenamed("id", "slot").withColumn(
        "point", F.expr(f"(slot % {RING}L) * {STEP}L % {RING}L"))
    width = RING // CELLS
    cells = goals.where("high > low").select(
        "key", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell"))
    drawn = slots.withColumn("cell", F.expr(f"point div {width}")).join(cells, "cell").where(
        "point >= low AND point < high").select("slot", "key", F.expr(f"slot div {STRETCH}").alias("stretch"))
    counts = drawn.groupBy("key", "stretch").agg(F.count("*").alias("n"))
    before = W.partitionBy("key").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("key", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(W.partitionBy("key", "stretch").orderBy("slot")) - 1
    ranked = drawn.withColumn("local", local).join(offsets, ["key", "stretch"]).select(
        "slot", "key", (F.col("offset") + F.col("local")).alias("k"))
    # A source too small to be drawn gets one slot at the end.
    missed = goals.where("words > 0").join(counts, "key", "left_anti").select(
        (F.lit(total) + F.col("rank")).alias("slot"), "key", F.lit(0).cast("long").alias("k"))
    return ranked.unionByName(missed)


def laid_out(sizes: DataFrame) -> DataFrame:
    """Where each row of each epoch begins in its source's stream of words."""
    rows = sizes.where("size > 0").withColumn("epoch", F.explode(F.array(*map(F.lit, range(EPOCHS))))).withColumn(
        "order", F.md5(F.concat_ws(":", "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))).withColumn(
        "bucket", F.substring("order", 1, 3))
    by_bucket = W.partitionBy("key").orderBy("epoch", "bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("key", "epoch", "bucket").agg(F.sum("size").alias("n")).select(
        "key", "epoch", "bucket", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)).alias("offset"))
    inside = W.partitionBy("key", "epoch", "bucket").orderBy("order", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, ["key", "epoch", "bucket"]).withColumn("begin", F.col("offset") + F.col("local")).select(
        "row", "doc_id", "key", "size", "begin")


def mix(sizes: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: per slot the words ``from_word`` to ``to_word`` of a row that it takes."""
    slots = materialize(schedule(goals, block_words), "mix-slots")
    parts = slots.groupBy("key").agg(F.count("*").alias("blocks"))
    # The first ``long`` blocks have one word more than the others, ``short`` each.
    cut = goals.join(parts, "key").select(
        "key", "words", F.expr("words div blocks").alias("short"), F.expr("words % blocks").alias("long"))

    def block_at(place: str) -> str:
        return (f"IF({place} < long * (short + 1), {place} div (short + 1), "
                f"long + ({place} - long * (short + 1)) div greatest(short, 1))")

    def begin_of(block: str) -> str:
        return f"{block} * short + least({block}, long)"

    pieces = laid_out(sizes).join(cut, "key").where("begin < words").withColumn(
        "end", F.expr("least(begin + size, words)")).withColumn(
        "k", F.explode(F.expr(f"sequence({block_at('begin')}, {block_at('(end - 1)')})")))
    pieces = pieces.select(
        "row", "doc_id", "key", "k",
        F.expr(f"greatest({begin_of('k')}, begin) - begin").alias("from_word"),
        F.expr(f"least({begin_of('(k + 1)')}, end) - begin").alias("to_word"))
    return pieces.join(slots, ["key", "k"]).select("slot", "key", "row", "doc_id", "from_word", "to_word")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: id, size, its source's size and target, and the words the mix takes of it."""
    sizes = sized(docs, doc_id, text, source)
    goals = materialize(targets(sizes), "mix-targets")
    taken = mix(sizes, goals).groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return sizes.join(goals.select("key", "source_size", "target"), "key").join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
