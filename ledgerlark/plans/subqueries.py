"""Subqueries, common table expressions and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows, moment, on_sale
from ledgerlark.operators import comparisons
from ledgerlark.operators.changes import delete_rows, update_rows
from ledgerlark.operators.closure import reached
from ledgerlark.operators.sets import row_differences, union_all
from ledgerlark.operators.stored_parts import StoredParts, stored_differences
from ledgerlark.plans.joining import settled_totals
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import CANCELLED, SETTLED, TABLE_NAMES, Tables

_TOTALS_SQL = """
    WITH totals AS (
        SELECT o_custkey, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT)
                   AS paid_cents
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' GROUP BY o_custkey)
"""


@query("""
    SELECT COUNT(*) AS orders, COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS cancelled,
           (SELECT COUNT(*) FROM lineitem) AS line_count,
           (SELECT CAST(ROUND(p_retailprice * 100) AS BIGINT) FROM part WHERE p_name = 'small ring'
            ORDER BY p_retailprice LIMIT 1) AS price_cents
    FROM orders
""")
def sub_scalar_select(t: Tables) -> DataFrame:
    """Several scalar subqueries side by side in one row."""
    cancelled = t.orders.where(F.col("o_orderstatus") == CANCELLED)
    price = t.part.where(F.col("p_name") == "small ring").agg(F.min(cents("p_retailprice")))
    return t.spark.range(1).select(
        t.orders.agg(count_rows()).scalar().alias("orders"),
        cancelled.agg(count_rows()).scalar().alias("cancelled"),
        t.lineitem.agg(count_rows()).scalar().alias("line_count"),
        price.scalar().alias("price_cents"),
    )


@query("""
    WITH a AS (SELECT *, AVG(CAST(ROUND(p_retailprice * 100) AS BIGINT)) OVER () AS base
               FROM part WHERE p_size > 10)
    SELECT p_partkey, p_name, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents
    FROM a WHERE CAST(ROUND(p_retailprice * 100) AS BIGINT) > base
""")
def sub_scalar_where(t: Tables) -> DataFrame:
    """Products on sale above the average of the products on sale."""
    offered = t.part.where(on_sale()).select(
        "p_partkey", "p_name", cents("p_retailprice").alias("price_cents")
    )
    average = offered.agg(F.avg("price_cents")).scalar()
    return offered.where(F.col("price_cents") > average).orderBy(
        F.desc("price_cents"), "p_partkey"
    )


@query("""
    SELECT c_custkey, c_name, (SELECT COUNT(*) FROM orders
        WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS settled_orders
    FROM customer
""")
def sub_corr_scalar(t: Tables) -> DataFrame:
    """A correlated count per customer; no match counts as zero.

    The orders are counted per customer first, so the subquery looks up one row.
    """
    settled = t.orders.where(F.col("o_orderstatus") == SETTLED)
    counted = settled.groupBy("o_custkey").agg(count_rows().alias("n"))
    mine = counted.where(F.col("o_custkey") == F.col("c_custkey").outer())
    found = mine.select(F.sum("n")).scalar()
    return t.customer.select(
        "c_custkey", "c_name", F.coalesce(found, F.lit(0)).alias("settled_orders")
    )


@query("""
    SELECT c_name, SUM_CENTS AS paid_cents FROM (
        SELECT c_name, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS SUM_CENTS
        FROM customer, orders, lineitem
        WHERE o_custkey = c_custkey AND l_orderkey = o_orderkey AND o_orderstatus = 'F'
        GROUP BY c_custkey, c_name)
""")
def sub_derived(t: Tables) -> DataFrame:
    """A summed derived table joined to the names."""
    return settled_totals(t).join(t.customer, "c_custkey").select("c_name", "paid_cents")


@query("""
    SELECT c_name, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS paid_cents
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'F' GROUP BY c_custkey, c_name
    HAVING SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) > (
        SELECT AVG(s) FROM (SELECT SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS s
                            FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                            WHERE o_orderstatus = 'F' GROUP BY o_custkey))
""")
def sub_having_scalar(t: Tables) -> DataFrame:
    """Customers whose paid sum is above the average paid sum."""
    totals = settled_totals(t)
    average = totals.agg(F.avg("paid_cents")).scalar()
    return (
        totals.where(F.col("paid_cents") > average)
        .join(t.customer, "c_custkey")
        .select("c_name", "paid_cents")
    )


@query(_TOTALS_SQL + """
    SELECT c_name, paid_cents FROM totals JOIN customer ON c_custkey = o_custkey
    WHERE paid_cents > (SELECT AVG(paid_cents) FROM totals)
""")
def cte_multi_ref(t: Tables) -> DataFrame:
    """One named table used twice; Spark reuses its shuffle for the second use."""
    return t.spark.sql(
        """
        WITH average AS (SELECT avg(paid_cents) AS average_cents FROM {totals})
        SELECT c_name, paid_cents FROM {totals} JOIN {customer} USING (c_custkey)
        WHERE paid_cents > (SELECT average_cents FROM average)
        """,
        totals=settled_totals(t), customer=t.customer,
    )


def _price_lists(t: Tables) -> dict[str, DataFrame]:
    """Three lists of prices: complete, with a NULL, and empty."""
    price = F.col("p_retailprice")
    brand = t.part.where(F.col("p_brand") == "Brand#7").select(price.alias("x"))
    holed = t.part.where(F.col("p_brand") == "Brand#7").select(
        F.when(F.col("p_size") != 20, price).alias("x")
    )
    return {"complete": brand, "with NULL": holed, "empty": brand.where(F.col("x") < 0)}


def _quantified(t: Tables, compare) -> DataFrame:
    return union_all([
        t.part.select(compare("p_retailprice", listed, "x").alias("holds")).agg(
            F.lit(name).alias("list"),
            F.count_if("holds").alias("true_rows"),
            F.count_if(~F.col("holds")).alias("false_rows"),
            F.count_if(F.col("holds").isNull()).alias("unknown_rows"),
        )
        for name, listed in _price_lists(t).items()
    ])


def _quantified_sql(operator: str) -> str:
    lists = {
        "complete": "SELECT p_retailprice FROM part WHERE p_brand = 'Brand#7'",
        "with NULL": "SELECT CASE WHEN p_size <> 20 THEN p_retailprice END FROM part "
                     "WHERE p_brand = 'Brand#7'",
        "empty": "SELECT p_retailprice FROM part WHERE p_brand = 'none'",
    }
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS list, COUNT(CASE WHEN h THEN 1 END) AS true_rows,
                   COUNT(CASE WHEN NOT h THEN 1 END) AS false_rows,
                   COUNT(*) - COUNT(h) AS unknown_rows
            FROM (SELECT p_retailprice > {operator} ({listed}) AS h FROM part)"""
        for name, listed in lists.items()
    )


@query(_quantified_sql("ALL"))
def quant_gt_all(t: Tables) -> DataFrame:
    """``> ALL`` over a complete, a holed and an empty list."""
    return _quantified(t, comparisons.above_all)


@query(_quantified_sql("ANY"))
def quant_gt_any(t: Tables) -> DataFrame:
    """``> ANY`` over a complete, a holed and an empty list."""
    return _quantified(t, comparisons.above_any)


@query("""
    SELECT COUNT(*) AS parts, TRUE AS highest_missing, CAST(0 AS BIGINT) AS guarded_cents FROM part
""")
def sub_scalar_empty(t: Tables) -> DataFrame:
    """A scalar subquery over no rows is NULL until it is guarded."""
    none = t.part.where(F.col("p_brand") == "none").select(cents("p_retailprice").alias("x"))
    missing = none.agg(F.max("x").alias("x"))
    return t.part.agg(count_rows().alias("parts")).select(
        "parts",
        missing.scalar().isNull().alias("highest_missing"),
        comparisons.single_value(none, "x", 0).cast("bigint").alias("guarded_cents"),
    )


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_retailprice = (SELECT MIN(p_retailprice) FROM part WHERE p_brand = 'Brand#7')
""")
def sub_scalar_guard(t: Tables) -> DataFrame:
    """A many-row subquery made single by an aggregate before it is compared."""
    lowest = t.part.where(F.col("p_brand") == "Brand#7").agg(F.min("p_retailprice").alias("x"))
    return t.part.where(
        F.col("p_retailprice") == comparisons.single_value(lowest, "x")
    ).select("p_partkey", "p_name")


@query("""
    SELECT CAST(y AS INTEGER) AS sales_year, (SELECT COUNT(*) FROM orders WHERE year(o_orderdate) = y)
               AS orders
    FROM (SELECT unnest(generate_series((SELECT MIN(year(o_orderdate)) FROM orders),
                                        (SELECT MAX(year(o_orderdate)) FROM orders) + 1)) AS y)
""")
def cte_recursive(t: Tables) -> DataFrame:
    """A calendar grown row by row from the first to the year after the last order."""
    return t.spark.sql(
        """
        WITH RECURSIVE bounds AS (
            SELECT min(year(o_orderdate)) AS low, max(year(o_orderdate)) AS high FROM {orders}),
        per_year AS (
            SELECT year(o_orderdate) AS sales_year, count(*) AS n FROM {orders} GROUP BY 1),
        calendar(sales_year, high) AS (
            SELECT low, high FROM bounds
            UNION ALL SELECT sales_year + 1, high FROM calendar WHERE sales_year <= high)
        SELECT sales_year, coalesce(n, 0) AS orders FROM calendar LEFT JOIN per_year USING (sales_year)
        """,
        orders=t.orders.select("o_orderdate"),
    )


@query("""
    WITH RECURSIVE link AS (
        SELECT DISTINCT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem
        UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem WHERE l_partkey % 7 = 0),
    reach(node, step) AS (
        SELECT 's0', 0 UNION SELECT b, step + 1 FROM reach JOIN link ON a = node WHERE step < 3)
    SELECT node, MIN(step) AS step FROM reach GROUP BY node
""")
def reach_bridge(t: Tables) -> DataFrame:
    """What one supplier is connected with in at most three steps over the bridge; every seventh
    product leads back to all its suppliers."""
    pairs = t.lineitem.select(F.concat(F.lit("s"), "l_suppkey").alias("s"), F.concat(F.lit("p"), "l_partkey").alias("p"), "l_partkey").distinct()
    back = pairs.where(F.col("l_partkey") % 7 == 0).select(F.col("p").alias("a"), F.col("s").alias("b"))
    links = pairs.select(F.col("s").alias("a"), F.col("p").alias("b")).unionByName(back)
    start = t.supplier.where(F.col("s_suppkey") == 0).select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return reached(links, "a", "b", start, "node", 3)


@query("""
    SELECT 'customer' AS kind, c_nationkey AS nation, COUNT(*) AS members FROM customer
    GROUP BY c_nationkey
    UNION ALL SELECT 'supplier', s_nationkey, COUNT(*) FROM supplier GROUP BY s_nationkey
""", name="union_all")
def union_all_rows(t: Tables) -> DataFrame:
    """Members per nation of both kinds, one below the other."""
    people = t.customer.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    sellers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    return people.unionByName(sellers).groupBy("kind", "nation").agg(count_rows().alias("members"))


@query("""
    SELECT l_partkey AS k FROM lineitem UNION SELECT o_custkey FROM orders
""")
def union_distinct(t: Tables) -> DataFrame:
    """UNION drops true duplicates; each branch is reduced before the shuffle."""
    return (
        t.lineitem.select(F.col("l_partkey").alias("k"))
        .union(t.orders.select(F.col("o_custkey")))
        .distinct()
    )


@query("""
    WITH a AS (SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL),
         b AS (SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders
               WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY ALL)
    SELECT *, CAST(1 AS BIGINT) AS left_rows, CAST(0 AS BIGINT) AS right_rows
    FROM (FROM a EXCEPT FROM b)
    UNION ALL SELECT *, 0, 1 FROM (FROM b EXCEPT FROM a)
""")
def golden_diff(t: Tables) -> DataFrame:
    """Rows of a report that changed against the copy stored a month earlier."""

    def report(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_custkey", "o_orderstatus").agg(count_rows().alias("n"))

    earlier = t.orders.where(F.col("o_orderdate") < moment("2001-07-01"))
    return row_differences(report(t.orders), report(earlier))


@query("""
    WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS total_cents
               FROM orders),
         b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey = 7 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                      total_cents FROM a WHERE (o_custkey = 11) IS NOT TRUE),
         x AS (SELECT *, COUNT(*) AS left_rows FROM a GROUP BY ALL),
         y AS (SELECT *, COUNT(*) AS right_rows FROM b GROUP BY ALL)
    SELECT o_orderkey, o_custkey, o_orderstatus, total_cents, left_rows, CAST(0 AS BIGINT) AS right_rows
    FROM x WHERE NOT EXISTS (SELECT 1 FROM y WHERE (y.o_orderkey, y.o_custkey, y.o_orderstatus, y.total_cents)
        IS NOT DISTINCT FROM (x.o_orderkey, x.o_custkey, x.o_orderstatus, x.total_cents))
    UNION ALL
    SELECT y.o_orderkey, y.o_custkey, y.o_orderstatus, y.total_cents, COALESCE(left_rows, 0), right_rows
    FROM y LEFT JOIN x ON (y.o_orderkey, y.o_custkey, y.o_orderstatus, y.total_cents)
        IS NOT DISTINCT FROM (x.o_orderkey, x.o_custkey, x.o_orderstatus, x.total_cents)
    WHERE left_rows IS DISTINCT FROM right_rows
""")
def diff_stored_parts(t: Tables) -> DataFrame:
    """What changed between two stored copies, reading only parts whose checksums differ."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("total_cents"))
    changed = update_rows(
        delete_rows(orders, F.col("o_custkey") == 11), F.col("o_custkey") == 7, {"o_orderstatus": F.lit(SETTLED)})
    left, right = (
        StoredParts(t.spark, run_folder(t.spark, "parts"), orders.schema, "o_orderkey", 256).write(copy)
        for copy in (orders, changed))
    return stored_differences(left, right)


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in TABLE_NAMES
))
def rowcount_report(t: Tables) -> DataFrame:
    """Rows of every table."""
    return union_all([
        t.read(name).agg(F.lit(name).alias("table_name"), count_rows().alias("row_count"))
        for name in TABLE_NAMES
    ])
