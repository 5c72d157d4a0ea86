"""Scalar functions: dates, NULL handling, text, types, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows
from ledgerlark.plans.registry import query
from ledgerlark.sources.tables import Tables


@query("""
    SELECT event_type, day_utc, day_local, COUNT(*) AS n,
           CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
    FROM (SELECT *, CAST(ts AS DATE) AS day_utc, CAST(ts + INTERVAL 9 HOURS AS DATE) AS day_local
          FROM events) GROUP BY event_type, day_utc, day_local
""")
def day_boundary_tz(t: Tables) -> DataFrame:
    """Daily sums under two clocks: nine hours move events over midnight."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), F.col("ts"))
    return t.events.groupBy(
        "event_type", F.to_date("ts").alias("day_utc"), F.to_date(local).alias("day_local")
    ).agg(count_rows().alias("n"), F.sum(cents("value")).alias("value_cents"))


@query("""
    SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT)
               AS k_sum,
           CAST(MAX(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT) AS k_max,
           CAST(0 AS BIGINT) AS other_reading
    FROM events GROUP BY event_type
""")
def json_attr(t: Tables) -> DataFrame:
    """A flexible attribute read from JSON text, parsed whole and by path."""
    parsed = F.from_json("props", "k BIGINT")["k"]
    by_path = F.get_json_object("props", "$.k").cast("bigint")
    as_variant = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    rows = t.events.select(
        "event_type", parsed.alias("k"), by_path.alias("p"), as_variant.alias("v")
    )
    same = F.col("k").eqNullSafe(F.col("p")) & F.col("k").eqNullSafe(F.col("v"))
    return rows.groupBy("event_type").agg(
        count_rows().alias("n"), F.sum("k").alias("k_sum"), F.max("k").alias("k_max"),
        F.count_if(~same).alias("other_reading"),
    )


@query("""
    SELECT strftime(o_orderdate, '%Y-%m') AS order_month, CAST(o_orderdate AS DATE) AS order_day,
           CAST(date_diff('day', o_orderdate, (SELECT MAX(o_orderdate) FROM orders)) AS INTEGER)
               AS days_before_last, COUNT(*) AS n
    FROM orders GROUP BY o_orderdate
""")
def date_functions(t: Tables) -> DataFrame:
    """Day, formatted month and distance in days."""
    last = t.orders.agg(F.max("o_orderdate")).scalar()
    date = F.col("o_orderdate")
    return t.orders.groupBy("o_orderdate").agg(count_rows().alias("n")).select(
        F.date_format(date, "yyyy-MM").alias("order_month"),
        F.to_date(date).alias("order_day"),
        F.datediff(last, date).alias("days_before_last"),
        "n",
    )


@query("""
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE c_mktsegment END AS by_coalesce,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE c_mktsegment END AS by_ifnull,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE c_mktsegment END AS by_nvl
    FROM customer
""")
def null_functions(t: Tables) -> DataFrame:
    """Three spellings of a default for NULL."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    none = F.lit("none")
    return t.customer.select(
        "c_custkey",
        F.coalesce(segment, none).alias("by_coalesce"),
        F.ifnull(segment, none).alias("by_ifnull"),
        F.nvl(segment, none).alias("by_nvl"),
    )


@query("""
    SELECT p_partkey, lower(p_type) AS lowered, CAST(length(p_name) AS INTEGER) AS name_length,
           replace(p_name, ' ', '-') AS slug, p_type IN ('ECONOMY') AS same_ignoring_case,
           FALSE AS same_exact
    FROM part
""")
def text_functions(t: Tables) -> DataFrame:
    """Case, length, replacement, and comparison under a case-blind collation."""
    blind = F.collate("p_type", "UTF8_LCASE")
    return t.part.select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        F.length("p_name").alias("name_length"),
        F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"),
        (blind == F.collate(F.lit("Economy"), "UTF8_LCASE")).alias("same_ignoring_case"),
        (F.col("p_type") == "Economy").alias("same_exact"),
    )


@query("""
    SELECT l_returnflag, COUNT(*) AS n,
           COUNT(TRY_CAST(CASE WHEN l_linenumber = 1 THEN l_returnflag
                               ELSE CAST(l_linenumber AS VARCHAR) END AS INTEGER)) AS numeric_rows,
           'string' AS stored_as
    FROM lineitem GROUP BY l_returnflag
""")
def type_functions(t: Tables) -> DataFrame:
    """Declared type of a text column, and how many of its values are numbers."""
    text = F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")).otherwise(
        F.col("l_linenumber").cast("string")
    )
    values = t.lineitem.select("l_returnflag", text.alias("value"))
    return values.groupBy("l_returnflag", F.typeof("value").alias("stored_as")).agg(
        count_rows().alias("n"),
        F.count(F.col("value").try_cast("int")).alias("numeric_rows"),
    )


@query("""
    SELECT CAST(ROUND(l_quantity * 0.5) AS BIGINT) AS rounded,
           CAST(TRUNC(l_quantity * 0.5) AS BIGINT) AS truncated, COUNT(*) AS n
    FROM lineitem GROUP BY ALL
""")
def round_and_cast(t: Tables) -> DataFrame:
    """Rounding half away from zero against cutting off."""
    half = F.col("l_quantity") * 0.5
    return t.lineitem.groupBy(
        F.round(half).cast("bigint").alias("rounded"), half.cast("bigint").alias("truncated")
    ).agg(count_rows().alias("n"))
