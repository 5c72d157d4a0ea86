"""Substring, word and typo-tolerant search over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ledgerlark.functions.columns import grams, query_grams, words
from ledgerlark.operators.layout import look_up, write_looked_up, write_sorted
from ledgerlark.sources.scratch import materialize

# Ids per posting block: bounds the list any one task holds for a common word.
BLOCK = 1024

# Texts whose runs a task sorts.
TEXTS_A_TASK = 10_000


def postings(df: DataFrame, key: str, terms: Column, name: str, tasks: int | None = None) -> DataFrame:
    """One row per text and distinct term.

    Texts are dealt out by key before their terms are taken, because a term list costs far
    more than reading its text: files that few tasks read would otherwise be few tasks' work.
    """
    dealt = df.repartition(tasks, key) if tasks else df.repartition(key)
    return dealt.select(key, F.explode(F.array_distinct(terms)).alias(name))


def inverted_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """Word -> ids, cut into blocks of the id range.

    A word found in every text would otherwise gather all ids in one group; with
    the block in the key no list exceeds ``BLOCK`` ids.
    """
    pairs = postings(df.select(key, text), key, words(text), "word")
    block = F.floor(F.col(key) / BLOCK).cast("bigint").alias("block")
    return pairs.groupBy("word", block).agg(F.sort_array(F.collect_list(key)).alias("ids"))


def word_search(index: DataFrame, key: str, word: str) -> DataFrame:
    """Ids of the texts that contain exactly this word."""
    return index.where(F.col("word") == word.lower()).select(F.explode("ids").alias(key))


def gram_index(df: DataFrame, key: str, text: str, path: str, size: int = 3) -> DataFrame:
    """A table of (gram, key) pairs, each file sorted by gram, written to ``path`` once for many lookups.

    A task writes the pairs of its own texts: there are hundreds to a text, so they cost far
    more to move than the texts. A gram found in every text is written by all tasks.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TEXTS_A_TASK))
    pairs = postings(df.select(key, text), key, grams(text, size), "gram", tasks)
    return write_sorted(pairs, ["gram", key], path)


def substring_search(
    df: DataFrame, key: str, text: str, term: str, index: DataFrame | None = None, size: int = 3
) -> DataFrame:
    """Texts containing ``term``, ignoring case.

    With an index, texts that hold every run of the term are candidates, and only
    those are verified. Without one, or for a term shorter than a run, the texts
    are scanned.
    """
    found = F.contains(F.lower(F.col(text)), F.lit(term.lower()))
    wanted = query_grams(term, size)
    if index is None or not wanted:
        return df.where(found)
    candidates = (
        index.where(F.col("gram").isin(wanted))
        .groupBy(key)
        .agg(F.count_distinct("gram").alias("_hits"))
        .where(F.col("_hits") == len(wanted))
        .select(key)
    )
    return df.join(candidates, key, "left_semi").where(found)


def similarity(text: str | Column, term: str, size: int = 3) -> Column:
    """Shared runs over all runs of a text and a term, 0 to 1."""
    own = grams(text, size)
    asked = F.array(*[F.lit(g) for g in query_grams(term, size)])
    union = F.size(F.array_union(own, asked))
    shared = F.size(F.array_intersect(own, asked))
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def most_similar(
    df: DataFrame, text: str, term: str, least: float, weight: Column | None = None
) -> DataFrame:
    """Distinct texts close to a misspelt term, the closest first."""
    weight = F.count(F.lit(1)) if weight is None else weight
    candidates = df.groupBy(text).agg(weight.alias("weight"))
    return (
        candidates.withColumn("similarity", F.round(similarity(text, term), 6))
        .where(F.col("similarity") >= least)
        .orderBy(F.desc("similarity"), F.desc("weight"), text)
    )


def similar_pairs(terms: DataFrame, term: str, df: DataFrame, text: str, least: float, size: int = 3) -> DataFrame:
    """(term, text, similarity) of all distinct pairs whose runs are at least ``least`` alike.

    Two sets that alike share one of their rarest runs, so each side enters the join with a
    prefix of its runs only, from the rarest on, as short as ``least`` allows; sets of too
    different size do not meet. A pair is compared once, on the whole sets. A frequent run
    stands in a prefix only where a text has hardly any other.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    # Similarities are rounded to six places before they are compared.
    bound = least - 1e-6
    sides = {
        "a": materialize(_gram_sets(terms, term, size), "term-runs"),
        "b": materialize(_gram_sets(df, text, size), "text-runs"),
    }
    listed = {side: sets.select("value", F.explode("runs").alias("run")) for side, sets in sides.items()}
    counts = listed["a"].unionByName(listed["b"]).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    heads = {}
    for side, rows in listed.items():
        ordered = rows.join(counts, "run").groupBy("value").agg(F.sort_array(F.collect_list(F.struct("n", "run")))["run"].alias("runs"))
        length = F.size("runs")
        head = F.slice("runs", F.lit(1), length - F.ceil(length * bound).cast("int") + 1)
        heads[side] = ordered.select(F.col("value").alias(side), length.alias(f"{side}_size"), F.explode(head).alias("run"))
    fits = (F.col("a_size") >= bound * F.col("b_size")) & (F.col("b_size") >= bound * F.col("a_size"))
    met = heads["a"].join(heads["b"], "run").where(fits).select("a", "b").distinct()
    whole = {side: sets.select(F.col("value").alias(side), F.col("runs").alias(f"{side}_runs")) for side, sets in sides.items()}
    shared = F.size(F.array_intersect("a_runs", "b_runs"))
    alike = F.round(shared / (F.size("a_runs") + F.size("b_runs") - shared), 6)
    return (
        met.join(whole["a"], "a").join(whole["b"], "b")
        .select(F.col("a").alias("term"), F.col("b").alias("text"), alike.alias("similarity"))
        .where(F.col("similarity") >= least)
    )


def _gram_sets(df: DataFrame, text: str, size: int) -> DataFrame:
    """Distinct texts with their runs; a text too short for one is like no other."""
    return df.select(F.col(text).alias("value")).distinct().withColumn("runs", grams("value", size)).where(F.size("runs") > 0)


# What a list of completions holds for each prefix.
COMPLETIONS = StructType().add("prefix", "string").add("place", "integer").add("text", "string").add("popularity", "long")


def write_completions(df: DataFrame, text: str, popularity: Column, size: int, longest: int, files: int, path: str) -> None:
    """The ``size`` most popular texts of every prefix up to ``longest`` letters, written once.

    Places are bounded before the rows are shuffled, so a prefix of a third of all texts
    sends ``size`` rows from each task.
    """
    known = df.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(popularity.cast("long").alias("popularity"))
    letters = F.sequence(F.lit(1), F.least(F.char_length("text"), F.lit(longest)))
    prefixes = F.when(F.col("text") == "", F.array()).otherwise(F.transform(letters, lambda n: F.substring("text", F.lit(1), n)))
    spread = known.select(F.explode(prefixes).alias("prefix"), "text", "popularity")
    order = Window.partitionBy("prefix").orderBy(F.desc("popularity"), "text")
    best = spread.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    write_looked_up(best.select("prefix", "place", "text", "popularity"), "prefix", ["place"], files, path)


def completions(spark: SparkSession, prefix: str, longest: int, files: int, path: str) -> DataFrame:
    """Stored completions of one prefix, from one file."""
    if not 0 < len(prefix) <= longest:
        raise ValueError(f"lists are stored for 1 to {longest} letters")
    return look_up(spark, COMPLETIONS, "prefix", prefix, files, path)


def suggestions(
    df: DataFrame, text: str, prefix: str, popularity: Column, size: int
) -> DataFrame:
    """Completions of a prefix, the most popular first."""
    return (
        df.where(F.col(text).startswith(prefix))
        .groupBy(text)
        .agg(popularity.alias("popularity"))
        .orderBy(F.desc("popularity"), text)
        .limit(size)
    )
