"""Text search over whole documents and product names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import search
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import Tables

_WORDS_SQL = r"""
    WITH pairs AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'))
                       AS word FROM documents)
"""


@query(_WORDS_SQL + """
    SELECT word, doc_id // 1024 AS block, COUNT(*) AS postings,
           string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids
    FROM pairs WHERE word <> '' GROUP BY word, block
""")
def inverted_index(t: Tables) -> DataFrame:
    """Word to document ids, in blocks of bounded length."""
    index = search.inverted_index(t.documents, "doc_id", "text")
    return index.select(
        "word", "block", F.size("ids").cast("bigint").alias("postings"),
        F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"),
    )


@query(_WORDS_SQL + """
    , w AS (SELECT doc_id FROM pairs WHERE word = 'the')
    SELECT doc_id, lang, doc_id IN (FROM w) AS has_word FROM documents
    WHERE lower(text) LIKE '%the%'
""")
def word_vs_substring(t: Tables) -> DataFrame:
    """Whole-word hits against substring hits: the index misses inner matches."""
    index = search.inverted_index(t.documents, "doc_id", "text")
    hits = search.word_search(index, "doc_id", "the").withColumn("hit", F.lit(True))
    texts = search.substring_search(t.documents, "doc_id", "text", "the")
    return texts.select("doc_id", "lang").join(hits, "doc_id", "left").select(
        "doc_id", "lang", F.coalesce("hit", F.lit(False)).alias("has_word")
    )


@query("""
    SELECT doc_id, lang, n_chars FROM documents WHERE lower(text) LIKE '%ation%'
""")
def trigram_search(t: Tables) -> DataFrame:
    """Substring search for one term: reading the texts once costs less than an index of them."""
    return search.substring_search(t.documents, "doc_id", "text", "ation").select("doc_id", "lang", "n_chars")


TERMS = ("tion re", "ÉTION", "%", "xyzzy")


@query(" UNION ALL ".join(
    f"SELECT '{term}' AS term, doc_id, lang FROM documents "
    f"WHERE contains(lower(text), lower('{term}'))" for term in TERMS
))
def trigram_search_stored(t: Tables) -> DataFrame:
    """Several terms looked up in one written index."""
    index = search.gram_index(t.documents, "doc_id", "text", run_folder(t.spark, "grams"))
    return union_all([
        search.substring_search(t.documents, "doc_id", "text", term, index).select(
            F.lit(term).alias("term"), "doc_id", "lang"
        )
        for term in TERMS
    ])


@query("""
    SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'ou')
""")
def short_term_scan(t: Tables) -> DataFrame:
    """A term shorter than a run falls back to reading the texts."""
    return search.substring_search(t.documents, "doc_id", "text", "ou").select("doc_id", "lang")


@query("""
    WITH n AS (SELECT p_name, COUNT(*) AS weight, list_distinct(list_transform(
                   generate_series(1, length(p_name) - 2), lambda i: substr(p_name, i, 3))) AS g
               FROM part GROUP BY p_name),
         q AS (SELECT list_transform(generate_series(1, 7), lambda i: substr('smal rign', i, 3)) AS a),
         s AS (SELECT p_name, weight, ROUND(len(list_intersect(g, q.a)) / CAST(len(list_distinct(
                   list_concat(g, q.a))) AS DOUBLE), 6) AS similarity FROM n, q)
    SELECT * FROM s WHERE similarity >= 0.1
""")
def trigram_similarity(t: Tables) -> DataFrame:
    """Product names close to a misspelt one."""
    return search.most_similar(t.part, "p_name", "smal rign", 0.1)


@query("""
    SELECT p_name, CAST(SUM(l_quantity) AS BIGINT) AS popularity
    FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_name LIKE 's%'
    GROUP BY p_name ORDER BY popularity DESC, p_name LIMIT 5
""")
def prefix_suggest(t: Tables) -> DataFrame:
    """Completions of a prefix by quantity sold."""
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    named = t.part.where(F.col("p_name").startswith("s")).join(sold, "p_partkey")
    return search.suggestions(named, "p_name", "s", F.sum("q"), 5)


_GRAM_SET = "list_distinct(list_transform(generate_series(1, length(x) - 2), lambda i: lower(substr(x, i, 3))))"


def typed(t: Tables) -> DataFrame:
    """Names with their kind, as they should be, and as they are typed with the third letter left out."""
    full = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    short = F.concat_ws(" ", "p_name", "p_type")
    return t.part.select(full.alias("name"), F.concat(F.substring(short, 1, 2), F.substring(short, 4, 100)).alias("asked"))


@query(f"""
    WITH n AS (SELECT DISTINCT p_name || ' ' || p_type || ' ' || p_brand AS x, {_GRAM_SET} AS g FROM part),
         q AS (SELECT DISTINCT substr(y, 1, 2) || substr(y, 4) AS x, {_GRAM_SET} AS g
               FROM (SELECT p_name || ' ' || p_type AS y FROM part)),
         s AS (SELECT q.x AS term, n.x AS text, len(list_intersect(n.g, q.g)) AS shared, len(n.g) + len(q.g) AS total FROM n, q)
    SELECT term, text, ROUND(shared / CAST(total - shared AS DOUBLE), 6) AS similarity FROM s
    WHERE ROUND(shared / CAST(total - shared AS DOUBLE), 6) >= 0.5
""")
def similarity_join(t: Tables) -> DataFrame:
    """Many misspelt names against all names, blocked by their rarest runs of letters."""
    names = typed(t)
    return search.similar_pairs(names, "asked", names, "name", 0.5)


# Prefixes people type: one letter, two, a word, a word and a half, and some that nothing begins with.
PREFIXES = (
    *"abcdefghijklmnoprstuvw", "bl", "bo", "ca", "co", "fa", "gr", "ho", "la", "mi", "ne", "ol", "re", "sh", "sl", "sm", "wa",
    "red", "small", "small ", "small r", "small ri", "blue g", "blue gi", "cold ", "hot w", "large", "x", "xy", "S",
)
COMPLETED, LONGEST, LIST_FILES = 5, 12, 16


@query(f"""
    WITH sold AS (SELECT p_name, CAST(SUM(l_quantity) AS BIGINT) AS popularity
                  FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_name),
         typed AS (SELECT unnest([{", ".join(f"'{p}'" for p in PREFIXES)}]) AS prefix)
    SELECT prefix, CAST(row_number() OVER w AS INTEGER) AS place, p_name AS text, popularity
    FROM typed JOIN sold ON starts_with(p_name, prefix)
    WINDOW w AS (PARTITION BY prefix ORDER BY popularity DESC, p_name) QUALIFY row_number() OVER w <= {COMPLETED}
""")
def prefix_suggest_stored(t: Tables) -> DataFrame:
    """Lists of completions written once; each of many prefixes opens one file."""
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    path = run_folder(t.spark, "completions")
    search.write_completions(t.part.join(sold, "p_partkey"), "p_name", F.sum("q"), COMPLETED, LONGEST, LIST_FILES, path)
    return union_all([search.completions(t.spark, prefix, LONGEST, LIST_FILES, path) for prefix in PREFIXES])
