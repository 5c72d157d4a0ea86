"""One named query per operator, over whole tables, and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    chat, decontaminate, line_dedup, mixing, near_dup, pitman_yor, quality_rules, secret_scan, suffix_dedup, token_alignment,
    toxicity, vector_codes, warc)
from ledgerlark.sources.scratch import run_folder

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The words of the decontamination contract, lower-cased in A to Z.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(rf"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
test AS (SELECT item_id, least(len(w), 10) AS size,
             unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                                   lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
         FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
place AS (SELECT r, s.size, unnest(range(1, len(w) - s.size + 2)) AS p, w
          FROM doc, (SELECT DISTINCT size FROM test) s WHERE len(w) >= s.size),
hit AS (SELECT place.r, p, place.size, item_id FROM place JOIN test
        ON test.size = place.size AND test.win = array_to_string(w[p:p + place.size - 1], ' ')),
covered AS (SELECT r, count(DISTINCT q) AS n_hit
            FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)""")
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows found in each document by suffix-array search."""
    found = decontaminate.find_matches(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"),
        carry=["doc_id"],
    )
    items = F.array_sort(F.array_distinct(F.filter(F.col("matches.item_id"), lambda i: i.isNotNull())))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )

@query()
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of each document, weak candidates only beside the parts they belong to."""
    found = secret_scan.scan(table(spark, folder, "documents"))
    strong = secret_scan.KINDS[:secret_scan.STRONG]

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, strong),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*strong))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


# Character classes as in the operator: a pattern each, and what is left beyond ASCII.
_CLASSES = ("[a-z]", "[A-Z]", "[0-9]", r"[ \t]", r"[\n\r]", "[.,;:!?]", r"[()\[\]{}''\x22-]",
            r"[#$%&*+/<=>@\\^_`|~]", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", r"[^\x00-\x7F]")


def _part(p: str, q: str) -> str:
    """What a bin of shares p and q adds to twice the divergence."""
    return (f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)")


@query(rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
                    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
class AS (SELECT r, lang, unnest(range(10)) AS c, unnest([{', '.join(
    f"length(text) - length(regexp_replace(text, '{c}', '', 'g'))" for c in _CLASSES)}]) AS n FROM doc),
word AS (SELECT r, lang, word, count(*) AS n FROM (SELECT r, lang, unnest(w) AS word FROM doc) GROUP BY ALL),
spoken AS (SELECT lang, sum(n) AS words FROM word GROUP BY lang),
large AS (SELECT lang, words FROM spoken WHERE lang <> '' AND words * {quality_rules.LANGUAGES} >= (SELECT sum(words) FROM spoken)),
judged AS (SELECT doc.*, coalesce(large.lang, '') AS ref FROM doc LEFT JOIN large USING (lang)),
seen AS (SELECT lang AS ref, word, sum(n) AS n, any_value(words) AS words FROM word JOIN large USING (lang) GROUP BY lang, word
         UNION ALL SELECT '', word, sum(n), (SELECT sum(words) FROM spoken) FROM word GROUP BY word),
common AS (SELECT ref, word, n / words AS q FROM seen WHERE n * {quality_rules.COMMON} >= words),
rest AS (SELECT ref, sum(q) AS q_all, greatest(0, 1 - sum(q)) AS q_rest FROM common GROUP BY ref),
met AS (SELECT r, sum(word.n) AS n, sum(q) AS q, sum({_part('(word.n / len(w))', 'q')}) AS js
        FROM word JOIN judged USING (r) JOIN common USING (ref, word) GROUP BY r),
by_word AS (SELECT r, sqrt(greatest(0, least(1, (coalesce(js, 0) + coalesce(rest.q_all, 0) - coalesce(met.q, 0)
                + {_part('((len(w) - coalesce(met.n, 0)) / len(w))', 'coalesce(q_rest, 1)')}) / 2))) AS d
            FROM judged LEFT JOIN met USING (r) LEFT JOIN rest USING (ref) WHERE len(w) > 0),
class_sum AS (SELECT lang AS ref, c, sum(n) AS n FROM class SEMI JOIN large USING (lang) GROUP BY lang, c
              UNION ALL SELECT '', c, sum(n) FROM class GROUP BY c),
class_share AS (SELECT ref, c, n / greatest(sum(n) OVER (PARTITION BY ref), 1) AS q FROM class_sum),
by_class AS (SELECT r, sum(n) AS chars, sqrt(greatest(0, least(1, sum(js) / 2))) AS d FROM (
    SELECT r, n, {_part('p', 'q')} AS js FROM (SELECT r, c, n, n / greatest(sum(n) OVER (PARTITION BY r), 1) AS p FROM class)
    JOIN judged USING (r) JOIN class_share USING (ref, c)) GROUP BY r),
line AS (SELECT r, i, unnest(l) AS line, unnest(range(len(l))) AS k FROM (SELECT r, 0 AS i, string_split(text, chr(10)) AS l FROM doc)),
dup AS (SELECT r, count(*) AS n FROM (SELECT r, row_number() OVER (PARTITION BY r, line ORDER BY k) AS nth FROM line
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) WHERE nth > 1 GROUP BY r),
gram AS (SELECT r, unnest(range(len(w) - 4)) AS k, unnest(list_transform(range(1, len(w) - 3),
             lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM doc WHERE len(w) >= 5),
again AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(k, k + 5)) AS j FROM (
              SELECT r, k, count(*) OVER (PARTITION BY r, g) AS times FROM gram) WHERE times > 1) GROUP BY r),
measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, chars,
        CASE WHEN chars > 0 THEN by_class.d ELSE 0 END AS dc, coalesce(by_word.d, 0) AS dw
    FROM doc LEFT JOIN dup USING (r) LEFT JOIN again USING (r) LEFT JOIN by_class USING (r) LEFT JOIN by_word USING (r)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (chars >= {quality_rules.MIN_CHARS} AND dc > {quality_rules.MAX_CHAR_DISTANCE})
       AND NOT (n_words >= {quality_rules.MIN_WORDS} AND dw > {quality_rules.MAX_WORD_DISTANCE}) AS kept,
       round(dc, 6) AS char_distance, round(dw, 6) AS word_distance FROM failed""")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality measures of each document and whether it is kept."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    measured = quality_rules.measure(docs, quality_rules.references(docs), carry=["doc_id"])
    failed = quality_rules.base_failed()
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~quality_rules.diverges()).alias("kept"),
        *(F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")),
    )

@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Junk, then toxic: the chain over the given labels, applied to every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    chain = toxicity.train(docs, labels, ["junk", "toxic"])
    return toxicity.predict(docs, chain, carry=["doc_id"]).select(
        "doc_id", "p_junk", "p_toxic", F.col("is_toxic").alias("toxic"))


_CHAT = """
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(regexp_replace(text, '<([|\\\\])', '<+\\1', 'g')) + 8)
            + sum(CASE WHEN new THEN 15 + length(role) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) <> role, TRUE) AS new FROM r)
GROUP BY conv_id"""


@query(_CHAT)
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, then read back from the formatted text."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"), F.lit(hostile).alias("text"))
    read = chat.read_back(chat.format_conversations(rows.unionByName(extra)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query(r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source,
                    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
src AS (SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM doc GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight, CAST(2 * s AS DOUBLE) AS cap FROM src),
levels AS (SELECT *, (1.5 * CAST(sum(s) OVER () AS DOUBLE)
                  - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goal AS (SELECT source, s, least(cap, coalesce(
             (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1) * weight, cap)) AS target
         FROM levels),
placed AS (SELECT r, size, floor(target) AS words, e * s + coalesce(sum(size) OVER (PARTITION BY doc.source, e
                  ORDER BY md5(e || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), size, r
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
           FROM doc JOIN goal ON doc.source IS NOT DISTINCT FROM goal.source, (VALUES (0), (1)) epoch(e)),
took AS (SELECT r, sum(greatest(least(begin + size, words) - begin, 0)) AS taken FROM placed GROUP BY r)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST(taken AS BIGINT) AS taken
FROM doc JOIN goal ON doc.source IS NOT DISTINCT FROM goal.source JOIN took USING (r)""")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of each document."""
    return mixing.mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")

# Base32 of the 160 bits of a digest, five bits a letter.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) * 16 + CAST(substr(bits, 5 * i + 2, 1) AS INTEGER) * 8
      + CAST(substr(bits, 5 * i + 3, 1) AS INTEGER) * 4 + CAST(substr(bits, 5 * i + 4, 1) AS INTEGER) * 2
      + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER), 1)), '')"""


@query(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS last,
             CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits FROM p)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to FROM r""")
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back from them; a record that fails a check is an error."""
    pages = table(spark, folder, "pages")
    path = run_folder(spark, "warc")
    warc.write_archives(pages, path)
    read = warc.sound_records(warc.read_archives(spark, path))
    id_type = pages.schema["page_id"].dataType
    return read.select(
        warc.from_urn("record_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.from_urn("refers_to").cast(id_type).alias("refers_to"))

@query("""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT r, p, hash(substr(h, 2 * p + 1, 400)) AS m
          FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS p FROM doc)),
again AS (SELECT m FROM place GROUP BY m HAVING count(*) > 1),
covered AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before,
                   lead(p) OVER (PARTITION BY r ORDER BY p) AS after FROM place SEMI JOIN again USING (m)),
edge AS (SELECT r, p AS low, row_number() OVER (PARTITION BY r ORDER BY p) AS i FROM covered
         WHERE before IS NULL OR p > before + 200),
stop AS (SELECT r, p + 200 AS high, row_number() OVER (PARTITION BY r ORDER BY p) AS i FROM covered
         WHERE after IS NULL OR after > p + 200),
span AS (SELECT r, i, low, high, lag(high, 1, 0) OVER (PARTITION BY r ORDER BY i) AS was FROM edge JOIN stop USING (r, i)),
kept AS (SELECT r, count(*) AS n_spans, sum(high - low) AS n_removed,
                string_agg(substr(h, 2 * was + 1, 2 * (low - was)), '' ORDER BY i)
                || substr(any_value(h), 2 * max(high) + 1) AS k FROM span JOIN doc USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM doc LEFT JOIN kept USING (r)""")
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without the byte strings that occur more than once."""
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) < 2 THEN w ELSE
                list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
alike AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT x, y FROM alike JOIN size a ON a.r = x JOIN size b ON b.r = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT r, r AS other FROM w UNION SELECT reach.r, y FROM reach JOIN both_ways ON x = other),
least_id AS (SELECT reach.r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = other GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN least_id USING (r) LEFT JOIN size USING (r)""")
def op9_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are alike."""
    found = near_dup.groups(table(spark, folder, "documents"), shingle=2)
    component = F.when(F.col("n") > 0, F.col("first_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


@query("""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, l FROM doc WHERE len(l) >= 3),
hashed AS (SELECT doc_id, i, array_to_string(l[i:i + 2], chr(10)) AS w FROM win
           WHERE regexp_matches(array_to_string(l[i:i + 2], ''), '\\S')),
later AS (SELECT doc_id, i FROM hashed
          QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS j FROM later),
line AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS j, unnest(l) AS body FROM doc),
mark AS (SELECT line.*, gone.j IS NOT NULL AS out,
                coalesce(lag(gone.j) OVER (PARTITION BY line.doc_id ORDER BY line.j), -9) = line.j - 1 AS before
         FROM line LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.j = line.j)
SELECT doc.doc_id, coalesce(count(j), 0) AS n_lines, count(j) FILTER (out) AS n_removed,
       count(j) FILTER (out AND NOT before) AS n_runs,
       CASE WHEN any_value(text) IS NOT NULL
            THEN coalesce(string_agg(body, chr(10) ORDER BY j) FILTER (NOT out), '') END AS text
FROM doc LEFT JOIN mark USING (doc_id) GROUP BY doc.doc_id""")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the runs of lines that occurred before."""
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "n_runs", "text")


@query()
def op11_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log probability by a model of the documents that are not held out."""
    return pitman_yor.score(table(spark, folder, "documents"))


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, with corpus-wide counts."""
    return token_alignment.align_texts(table(spark, folder, "documents"))


def _rounds_sql() -> str:
    """The rounds of fitting as one step after the other."""
    gap = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min({{'d': {gap}, 'e': e}}) AS m
            FROM part JOIN book{i} USING (p) GROUP BY r, p)""")
        if i < vector_codes.ROUNDS:
            steps.append(f"""book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(fresh, c) AS c FROM book{i} LEFT JOIN (
                SELECT p, e, list(y ORDER BY i) AS fresh FROM (
                    SELECT p, m.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS y
                    FROM near{i}, (SELECT unnest(range(1, (SELECT any_value(len(x)) FROM part) + 1)) AS i) GROUP BY ALL)
                GROUP BY p, e) USING (p, e))""")
    return ",\n".join(steps)


@query(f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
                     list_transform(embedding, lambda x: CAST(floor({vector_codes.GRID} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM (SELECT r, v, unnest(range(8)) AS p FROM kept)),
book0 AS (SELECT p, r AS e, x AS c FROM part WHERE r < {vector_codes.ENTRIES}),
{_rounds_sql()},
coded AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
          FROM near{vector_codes.ROUNDS} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS d FROM book{vector_codes.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (r), digest""")
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as one small code per part, with its squared error."""
    return vector_codes.compress(table(spark, folder, "embeddings"))


def queries() -> dict[str, Run]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
