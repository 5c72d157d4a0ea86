"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, line_cents, moment, on_sale, prefix_end
from ledgerlark.operators.sorting import sort_by_choice
from ledgerlark.plans.registry import query
from ledgerlark.sources.tables import CANCELLED, SETTLED, Tables


@query("""
    SELECT p_partkey, p_name, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents, p_brand
    FROM part WHERE p_size > 10 ORDER BY price_cents DESC, p_partkey
""")
def filter_eq_sort(t: Tables) -> DataFrame:
    return (
        t.part.where(on_sale())
        .select("p_partkey", "p_name", cents("p_retailprice").alias("price_cents"), "p_brand")
        .orderBy(F.desc("price_cents"), "p_partkey")
    )


@query("""
    SELECT p_name, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents,
           CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS available
    FROM part WHERE NOT p_retailprice < 950
""")
def filter_range_hidden_sort(t: Tables) -> DataFrame:
    return (
        t.part.where(F.col("p_retailprice") >= 950)
        .orderBy(F.desc("p_retailprice"), "p_partkey")
        .select("p_name", cents("p_retailprice").alias("price_cents"),
                on_sale().cast("int").alias("available"))
    )


@query("""
    SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 10
    INTERSECT SELECT p_partkey, p_name, p_size FROM part WHERE p_retailprice > 950
""")
def filter_and(t: Tables) -> DataFrame:
    return t.part.where(on_sale() & (F.col("p_retailprice") > 950)).select(
        "p_partkey", "p_name", "p_size"
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1998-03-31'
""")
def filter_between(t: Tables) -> DataFrame:
    return t.orders.where(
        F.col("o_orderdate").between(moment("1998-01-01"), moment("1998-03-31"))
    ).select("o_orderkey", "o_custkey", "o_orderdate")


@query("""
    SELECT o_orderstatus,
           CAST(SUM(CASE WHEN o_orderstatus = 'F' OR o_orderstatus = 'O' THEN 1 ELSE 0 END)
                AS BIGINT) AS listed,
           COUNT(*) - COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS unknown_with_null
    FROM orders GROUP BY o_orderstatus
""")
def filter_in_list(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    with_null = status.isin(SETTLED, None)
    return t.orders.groupBy("o_orderstatus").agg(
        F.count_if(status.isin("F", "O")).alias("listed"),
        F.count_if(with_null.isNull()).alias("unknown_with_null"),
    )


@query("""
    WITH c AS (SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment FROM customer)
    SELECT CAST(COUNT(*) - COUNT(segment) AS BIGINT) AS missing, COUNT(segment) AS present,
           CAST(SUM(CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END) AS BIGINT) AS equal_rows,
           CAST(SUM(CASE WHEN segment <> 'MACHINERY' THEN 1 ELSE 0 END) AS BIGINT) AS other_rows
    FROM c
""")
def filter_is_null(t: Tables) -> DataFrame:
    segment = F.col("segment")
    people = t.customer.select(
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return people.agg(
        F.count_if(segment.isNull()).alias("missing"),
        F.count_if(segment.isNotNull()).alias("present"),
        F.count_if(segment == "MACHINERY").alias("equal_rows"),
        F.count_if(segment != "MACHINERY").alias("other_rows"),
    )


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
           COUNT(CASE WHEN NULLIF(l_returnflag, 'N') IS NOT DISTINCT FROM NULLIF(l_linestatus, 'O')
                      THEN 1 END) AS same_or_both_missing,
           COUNT(CASE WHEN NULLIF(l_returnflag, 'N') = NULLIF(l_linestatus, 'O') THEN 1 END) AS same
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def null_safe_eq(t: Tables) -> DataFrame:
    flag = F.nullif("l_returnflag", F.lit("N"))
    state = F.nullif("l_linestatus", F.lit("O"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(flag.eqNullSafe(state)).alias("same_or_both_missing"),
        F.count_if(flag == state).alias("same"),
    )


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'
                         UNION SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def filter_or(t: Tables) -> DataFrame:
    return t.orders.where(
        (F.col("o_orderstatus") == CANCELLED) | (F.col("o_orderpriority") == "1-URGENT")
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'
""")
def filter_or_union(t: Tables) -> DataFrame:
    """The same OR as two branches united on the key."""
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    cancelled = t.orders.where(F.col("o_orderstatus") == CANCELLED).select(columns)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(columns)
    return cancelled.union(urgent).distinct()


@query("""
    SELECT COUNT(*) FILTER (WHERE lower(c_mktsegment) = 'building') AS by_lower,
           COUNT(*) FILTER (WHERE c_nationkey + 0 = 7) AS by_arithmetic,
           COUNT(*) FILTER (WHERE CAST(c_nationkey AS VARCHAR) = '7') AS by_cast,
           COUNT(*) FILTER (WHERE length(c_mktsegment) = 9) AS by_length
    FROM customer
""")
def filter_expr(t: Tables) -> DataFrame:
    return t.customer.agg(
        F.count_if(F.lower("c_mktsegment") == "building").alias("by_lower"),
        F.count_if(F.col("c_nationkey") + 0 == 7).alias("by_arithmetic"),
        F.count_if(F.col("c_nationkey").cast("string") == "7").alias("by_cast"),
        F.count_if(F.length("c_mktsegment") == 9).alias("by_length"),
    )


@query("""
    SELECT p_partkey, p_name, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents
    FROM part WHERE lower(p_name) LIKE '%ing%' ORDER BY price_cents DESC, p_partkey
""")
def like_contains(t: Tables) -> DataFrame:
    return (
        t.part.where(F.col("p_name").ilike("%ING%"))
        .select("p_partkey", "p_name", cents("p_retailprice").alias("price_cents"))
        .orderBy(F.desc("price_cents"), "p_partkey")
    )


@query("""
    SELECT p_partkey, p_name, TRUE AS by_start, TRUE AS by_pattern, TRUE AS by_range
    FROM part WHERE p_name LIKE 'small%'
""")
def like_prefix(t: Tables) -> DataFrame:
    name = F.col("p_name")
    start = name.startswith("small")
    pattern = name.rlike("^small")
    between = (name >= "small") & (name < prefix_end("small"))
    return t.part.where(start | pattern | between).select(
        "p_partkey", "p_name",
        start.alias("by_start"), pattern.alias("by_pattern"), between.alias("by_range"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(ROUND(l_quantity) AS BIGINT) * CAST(ROUND(p_retailprice * 100) AS BIGINT)
               AS line_total_cents
    FROM lineitem, part WHERE l_partkey = p_partkey
""")
def project_arith(t: Tables) -> DataFrame:
    prices = t.part.select(
        F.col("p_partkey").alias("l_partkey"), cents("p_retailprice").alias("price_cents")
    )
    return t.lineitem.join(prices, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity").cast("bigint") * F.col("price_cents")).alias("line_total_cents"),
    )


@query("""
    SELECT o_orderpriority, COUNT(*) AS orders,
           CASE WHEN COUNT(*) > (SELECT COUNT(*) FROM orders) / 5.0
                THEN 'above an equal share' ELSE 'at or below' END AS note
    FROM orders GROUP BY o_orderpriority
""")
def case_label(t: Tables) -> DataFrame:
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders")).withColumn(
        "note",
        F.when(F.col("orders") * 5 > total, "above an equal share").otherwise("at or below"),
    )


@query("""
    SELECT p_partkey,
           CAST((SELECT COALESCE(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)), 0) FROM lineitem
                 WHERE l_partkey = p_partkey AND l_shipdate >= TIMESTAMP '1998-01-01'
                   AND l_shipdate < TIMESTAMP '1998-04-01') AS BIGINT) AS sold_cents
    FROM part
""")
def coalesce_zero(t: Tables) -> DataFrame:
    quarter = F.col("l_shipdate").between(moment("1998-01-01"), moment("1998-03-31"))
    sold = (
        t.lineitem.where(quarter)
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum(line_cents()).alias("sold"))
    )
    return t.part.select("p_partkey").join(sold, "p_partkey", "left").select(
        "p_partkey", F.coalesce("sold", F.lit(0)).alias("sold_cents")
    )


@query("""
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_orderkey IN (
            SELECT l_orderkey FROM lineitem WHERE l_partkey IN (
                SELECT p_partkey FROM part WHERE p_name = 'small ring')))
""")
def distinct_rows(t: Tables) -> DataFrame:
    """Join down to the lines, then drop the copies the fan-out made."""
    named = t.part.where(F.col("p_name") == "small ring").select("p_partkey")
    lines = t.lineitem.join(named, F.col("l_partkey") == F.col("p_partkey"))
    bought = lines.select(F.col("l_orderkey").alias("o_orderkey")).join(t.orders, "o_orderkey")
    return (
        bought.select(F.col("o_custkey").alias("c_custkey"))
        .join(t.customer, "c_custkey")
        .select("c_custkey", "c_name")
        .dropDuplicates()
        .orderBy("c_custkey")
    )


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1997-06-15', 7000)
""")
def row_value_cmp(t: Tables) -> DataFrame:
    """Lexicographic comparison; the date bound alone reaches the scan."""
    bound = F.struct(
        moment("1997-06-15").alias("o_orderdate"),
        F.lit(7000).cast("bigint").alias("o_orderkey"),
    )
    return t.orders.where(
        (F.col("o_orderdate") <= moment("1997-06-15"))
        & (F.struct("o_orderdate", "o_orderkey") < bound)
    ).select("o_orderkey", "o_orderdate")


@query("""
    SELECT 'plain' AS input, COUNT(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT 'hostile', COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'' OR ''1''=''1'
""")
def bind_params(t: Tables) -> DataFrame:
    """A bound value is data: quotes inside it never become SQL."""
    text = (
        "SELECT :label AS input, count(*) AS n FROM {orders} WHERE o_orderpriority = :wanted"
    )

    def matching(label: str, wanted: str) -> DataFrame:
        return t.spark.sql(text, args={"label": label, "wanted": wanted}, orders=t.orders)

    return matching("plain", "1-URGENT").union(matching("hostile", "1-URGENT' OR '1'='1"))


@query("""
    SELECT c_custkey, c_name, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS balance_cents
    FROM customer ORDER BY balance_cents DESC, c_custkey
""")
def sort_whitelist(t: Tables) -> DataFrame:
    """The caller names a sort column; only listed names reach the plan."""
    people = t.customer.select("c_custkey", "c_name", cents("c_acctbal").alias("balance_cents"))
    allowed = {"balance": F.desc("balance_cents"), "name": F.asc("c_name")}
    return sort_by_choice(people, "balance", allowed, F.asc("c_custkey"))


@query("""
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
           CAST(ROUND(c_acctbal * 100) AS BIGINT) AS balance_cents, c_mktsegment
    FROM customer
""")
def scan_typed(t: Tables) -> DataFrame:
    """A whole table read with the declared schema, money as whole cents."""
    return t.customer.select(
        "c_custkey", "c_name", "c_nationkey", cents("c_acctbal").alias("balance_cents"),
        "c_mktsegment",
    )


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE date_diff('day', o_orderdate, (SELECT MAX(o_orderdate) FROM orders)) <= 7
""")
def recent_days(t: Tables) -> DataFrame:
    """The last seven days before the newest order."""
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.where(
        F.col("o_orderdate") >= newest - F.expr("INTERVAL 7 DAYS")
    ).select("o_orderkey", "o_orderdate")
