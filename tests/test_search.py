"""Text search against plain Python on whole texts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.columns import grams, query_grams
from ledgerlark.operators import search
from ledgerlark.sources.scratch import run_folder

TEXTS = [
    "抹茶ケーキ", "チーズケーキ large", "Green Tea", "a\nnew line, tea", "", "te", "TEA",
    "İstanbul tea", "x" * 5000 + "needle" + "y" * 5000, "emoji 😀😀tea", None,
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, texts):
    return search.gram_index(texts, "id", "text", run_folder(spark, "test-grams"))


TERMS = ["ーキ", "ズケー", "ケーキ", "tea", "TEA", "needle", "e, t", "😀te", "zzz", "\nne"]


@pytest.mark.parametrize("term", TERMS)
def test_no_match_is_lost(texts, index, term):
    want = {i for i, t in enumerate(TEXTS) if t is not None and term.lower() in t.lower()}
    with_index = search.substring_search(texts, "id", "text", term, index)
    scanned = search.substring_search(texts, "id", "text", term)
    assert {r.id for r in with_index.collect()} == {r.id for r in scanned.collect()} == want


def test_grams_equal_python(texts):
    rows = texts.where("text IS NOT NULL AND id <> 7").select("text", grams("text").alias("g"))
    for row in rows.collect():
        assert sorted(row.g) == query_grams(row.text)


def test_candidates_are_verified(spark):
    """All runs of the term occur, but not next to each other."""
    texts = spark.createDataFrame([(1, "abcd bcde"), (2, "abcde")], "id bigint, text string")
    index = search.gram_index(texts, "id", "text", run_folder(texts.sparkSession, "test-verify"))
    found = search.substring_search(texts, "id", "text", "abcde", index).collect()
    assert [r.id for r in found] == [2]


def test_word_index_misses_inner_text(texts):
    index = search.inverted_index(texts, "id", "text")
    assert search.word_search(index, "id", "ケーキ").count() == 0
    assert [r.id for r in search.word_search(index, "id", "抹茶ケーキ").collect()] == [0]


def test_common_word_is_cut_into_blocks(spark):
    texts = spark.range(5000).select("id", F.lit("the same").alias("text"))
    lists = search.inverted_index(texts, "id", "text").collect()
    assert max(len(r.ids) for r in lists) <= search.BLOCK
    assert sorted(i for r in lists if r.word == "the" for i in r.ids) == list(range(5000))


def test_similarity_is_jaccard(spark):
    names = ["small ring", "small rung", "big bolt"] * 3
    random.Random(3).shuffle(names)
    rows = search.most_similar(
        spark.createDataFrame([(n,) for n in names], "name string"), "name", "smal ring", 0.0
    ).collect()
    asked = set(query_grams("smal ring"))
    for row in rows:
        own = set(query_grams(row["name"]))
        assert row.similarity == round(len(own & asked) / len(own | asked), 6)
        assert row.weight == 3
    assert rows[0]["name"] == "small ring"


def test_suggestions_are_ranked(spark):
    rows = spark.createDataFrame([("sa", 1), ("sb", 5), ("sa", 7), ("t", 99)], "n string, q int")
    got = search.suggestions(rows, "n", "s", F.sum("q"), 5).collect()
    assert [(r.n, r.popularity) for r in got] == [("sa", 8), ("sb", 5)]


def names_and_terms(spark, seed: int):
    draw = random.Random(seed)
    words = ["small", "ring", "red", "widget", "cold", "gear", "rod", "aaaa", "aab"]
    names = [" ".join(draw.choices(words, k=draw.randint(1, 4))) for _ in range(80)] + [None, "", "ab", "small ring"] * 2
    terms = [n[:2] + n[3:] if n else n for n in names[::2]] + ["small ring", "zzz", "SMALL RING"]
    return names, terms, spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(n,) for n in terms], "q string")


@pytest.mark.parametrize("least", [0.05, 0.3, 0.5, 0.8, 1.0])
def test_similar_pairs_equal_brute_force(spark, least):
    names, terms, texts, asked = names_and_terms(spark, 5)
    want = set()
    for term in set(terms) - {None}:
        for name in set(names) - {None}:
            a, b = set(query_grams(term)), set(query_grams(name))
            if a and b and round(len(a & b) / len(a | b), 6) >= least:
                want.add((term, name, round(len(a & b) / len(a | b), 6)))
    got = search.similar_pairs(asked.repartition(3), "q", texts.repartition(3), "n", least).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and want


def test_similar_pairs_refuse_and_empty(spark):
    names, _, texts, asked = names_and_terms(spark, 6)
    for least in (0, -1, 1.01):
        with pytest.raises(ValueError):
            search.similar_pairs(asked, "q", texts, "n", least)
    assert search.similar_pairs(asked.limit(0), "q", texts, "n", 0.5).count() == 0


def test_similar_pairs_block(spark):
    """Far fewer pairs are compared than there are, and none by a product of the sides."""
    texts = spark.range(400).select(F.concat(F.lit("common start "), F.sha2(F.col("id").cast("string"), 256)).alias("n"))
    pairs = search.similar_pairs(texts, "n", texts, "n", 0.7)
    assert pairs.count() == 400
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def completed(spark):
    path = run_folder(spark, "test-completions")
    rows = [("sa", 1), ("sb", 5), ("sa", 7), ("t", 99), ("日本", 3), ("日本語", 4), ("", 9), (None, 9), ("S", 1), ("sc", 5), ("sdddd", 2)]
    search.write_completions(spark.createDataFrame(rows, "n string, q int"), "n", F.sum("q"), 3, 3, 8, path)
    return path


@pytest.mark.parametrize("prefix, want", [
    ("s", ["sa", "sb", "sc"]), ("sa", ["sa"]), ("S", ["S"]), ("日本", ["日本語", "日本"]), ("sdd", ["sdddd"]), ("x", []), ("t", ["t"]),
])
def test_stored_completions(spark, completed, prefix, want):
    found = search.completions(spark, prefix, 3, 8, completed)
    assert [r.text for r in sorted(found.collect(), key=lambda r: r.place)] == want
    assert len(found.inputFiles()) <= 1 or found.select("prefix", F.input_file_name().alias("f")).select("f").distinct().count() <= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot" in plan


def test_completions_are_for_stored_lengths(spark, completed):
    for prefix in ("", "sddd"):
        with pytest.raises(ValueError):
            search.completions(spark, prefix, 3, 8, completed)


def test_a_frequent_prefix_is_bounded_before_the_shuffle(spark):
    path = run_folder(spark, "test-hot-prefix")
    rows = spark.range(0, 30_000, 1, 8).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("n"), "id")
    search.write_completions(rows, "n", F.max("id"), 5, 1, 4, path)
    assert [r.popularity for r in search.completions(spark, "p", 1, 4, path).orderBy("place").collect()] == [29999, 29998, 29997, 29996, 29995]


def test_pairs_stay_where_their_text_is(spark, monkeypatch):
    monkeypatch.setattr(search, "TEXTS_A_TASK", 20)
    rows = spark.createDataFrame([(i, f"the station {i} of many words") for i in range(200)], "id bigint, text string")
    index = search.gram_index(rows, "id", "text", run_folder(spark, "test-local"))
    files = index.withColumn("file", F.col("_metadata.file_path"))
    assert files.select("file").distinct().count() > 4
    assert files.select("id", "file").distinct().count() == 200
    expected = rows.select("id", F.explode(grams("text")).alias("gram")).select("gram", "id")
    assert sorted(index.select("gram", "id").collect()) == sorted(expected.collect())
