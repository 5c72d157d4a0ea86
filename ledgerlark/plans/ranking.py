"""Windows, top-k, paging and sort rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import count_rows, line_cents, moment, or_zero
from ledgerlark.operators.ranking import page_by_offset, with_position, with_rank
from ledgerlark.plans.aggregation import settled_orders
from ledgerlark.plans.joining import settled_totals
from ledgerlark.plans.registry import query
from ledgerlark.sources.tables import SETTLED, Tables

_PAID_SQL = """
    WITH paid AS (
        SELECT c_custkey, c_name,
               CAST(COALESCE(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)), 0) AS BIGINT)
                   AS paid_cents
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
        LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey, c_name)
"""


def paid(t: Tables) -> DataFrame:
    return t.customer.join(settled_totals(t), "c_custkey", "left").select(
        "c_custkey", "c_name", or_zero("paid_cents").alias("paid_cents")
    )


@query(_PAID_SQL + """
    SELECT c_custkey, paid_cents, RANK() OVER (ORDER BY paid_cents DESC) AS place_shared,
           ROW_NUMBER() OVER (ORDER BY paid_cents DESC, c_custkey) AS place_unique
    FROM paid
""")
def win_rank(t: Tables) -> DataFrame:
    """Shared and unique places by paid sum; customers at zero share the last one."""
    totals = paid(t).select("c_custkey", "paid_cents")
    order = [F.desc("paid_cents"), F.asc("c_custkey")]
    return with_rank(totals, "paid_cents", order, "place_shared", "place_unique")


@query(_PAID_SQL + """
    SELECT c_custkey, paid_cents, ROUND(AVG(paid_cents) OVER (), 4) AS average_cents,
           paid_cents > AVG(paid_cents) OVER () AS above
    FROM paid
""")
def win_avg_over(t: Tables) -> DataFrame:
    """The overall average next to each row, as a one-row subquery."""
    totals = paid(t).select("c_custkey", "paid_cents")
    average = totals.agg(F.avg("paid_cents")).scalar()
    return totals.withColumn("average_cents", F.round(average, 4)).withColumn(
        "above", F.col("paid_cents") > average
    )


@query("""
    SELECT o_custkey, l_partkey, quantity FROM (
        SELECT o_custkey, l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS quantity,
               ROW_NUMBER() OVER (PARTITION BY o_custkey
                                  ORDER BY SUM(l_quantity) DESC, l_partkey) AS place
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)
    WHERE place = 1
""")
def win_top1_per_group(t: Tables) -> DataFrame:
    """Most ordered product of each customer.

    A maximum over (quantity, smaller key first) combines on the map side, where
    a window would sort each customer's whole group in one task.
    """
    per_pair = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "l_partkey")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    )
    best = F.max(F.struct("q", (-F.col("l_partkey")).alias("rest"))).alias("best")
    return per_pair.groupBy("o_custkey").agg(best).select(
        "o_custkey", (-F.col("best.rest")).alias("l_partkey"), F.col("best.q").alias("quantity")
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM (
        SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders) WHERE place <= 5
""")
def topk_recent(t: Tables) -> DataFrame:
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        .orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
        .limit(5)
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM (
        SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders WHERE o_orderstatus = 'F') WHERE place <= 10
""")
def topk_filtered(t: Tables) -> DataFrame:
    """Newest ten settled orders; the key breaks ties of equal dates."""
    return (
        t.orders.where(F.col("o_orderstatus") == SETTLED)
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        .orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
        .limit(10)
    )


@query("""
    SELECT p_partkey, p_name, CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
    FROM lineitem, part, orders
    WHERE p_partkey = l_partkey AND o_orderkey = l_orderkey AND o_orderstatus = 'F'
    GROUP BY p_partkey, p_name ORDER BY total_quantity DESC, total_cents DESC, p_partkey LIMIT 5
""")
def topk_products(t: Tables) -> DataFrame:
    """Five best-selling products by quantity, then sales, then key."""
    settled = t.orders.where(F.col("o_orderstatus") == SETTLED).select("o_orderkey")
    sold = (
        t.lineitem.join(settled, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
            F.sum(line_cents()).alias("total_cents"),
        )
        .orderBy(F.desc("total_quantity"), F.desc("total_cents"), "p_partkey")
        .limit(5)
    )
    return (
        sold.join(t.part, "p_partkey")
        .select("p_partkey", "p_name", "total_quantity", "total_cents")
        .orderBy(F.desc("total_quantity"), F.desc("total_cents"), "p_partkey")
    )


@query("""
    SELECT c_custkey, c_name, COUNT(DISTINCT o_orderkey) AS order_count,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS paid_cents
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'F' GROUP BY c_custkey, c_name
    ORDER BY paid_cents DESC, c_custkey LIMIT 3
""")
def topk_customers(t: Tables) -> DataFrame:
    """Three best customers by paid sum; names are looked up for those three."""
    best = (
        settled_orders(t)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(count_rows().alias("order_count"), F.sum("order_cents").alias("paid_cents"))
        .orderBy(F.desc("paid_cents"), "c_custkey")
        .limit(3)
    )
    return (
        best.join(t.customer, "c_custkey")
        .select("c_custkey", "c_name", "order_count", "paid_cents")
        .orderBy(F.desc("paid_cents"), "c_custkey")
    )


@query(_PAID_SQL + "SELECT c_name, paid_cents FROM paid ORDER BY paid_cents DESC, c_custkey LIMIT 3")
def topk_derived(t: Tables) -> DataFrame:
    """Three best customers from a derived table summed beforehand."""
    best = settled_totals(t).orderBy(F.desc("paid_cents"), "c_custkey").limit(3)
    return best.join(t.customer, "c_custkey").select("c_name", "paid_cents")


_PAGE_SIZE = 20
_NEWEST = [("o_orderdate", False), ("o_orderkey", False)]


def newest_first() -> list[Column]:
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20 OFFSET 100
""")
def page_offset(t: Tables) -> DataFrame:
    return page_by_offset(t.orders.select("o_orderkey", "o_orderdate"), _NEWEST, 100, _PAGE_SIZE)


@query("""
    SELECT o_orderkey, o_orderdate FROM (
        SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders) WHERE place > 12000 AND place <= 12020
""")
def page_offset_deep(t: Tables) -> DataFrame:
    """A page far down the order."""
    return page_by_offset(t.orders.select("o_orderkey", "o_orderdate"), _NEWEST, 12_000, _PAGE_SIZE)


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1998-06-15', 7000)
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20
""")
def page_keyset(t: Tables) -> DataFrame:
    """The page after the last row seen; the date bound prunes at the scan."""
    day, key = moment("1998-06-15"), 7000
    date = F.col("o_orderdate")
    after = (date <= day) & ((date < day) | (F.col("o_orderkey") < key))
    return t.orders.where(after).select("o_orderkey", "o_orderdate").orderBy(*newest_first()).limit(
        _PAGE_SIZE
    )


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_retailprice = (SELECT MAX(p_retailprice) FROM part)
""")
def scalar_order_limit1(t: Tables) -> DataFrame:
    """``ORDER BY .. LIMIT 1`` as a scalar, then every row that reaches it."""
    top = t.part.orderBy(F.desc("p_retailprice")).limit(1).select("p_retailprice").scalar()
    return t.part.where(F.col("p_retailprice") == top).select("p_partkey", "p_name")


@query("""
    SELECT segment, ROW_NUMBER() OVER (ORDER BY segment NULLS FIRST) AS nulls_first_place,
           ROW_NUMBER() OVER (ORDER BY segment NULLS LAST) AS nulls_last_place, customers
    FROM (SELECT NULLIF(c_mktsegment, 'BUILDING') AS segment, COUNT(*) AS customers
          FROM customer GROUP BY 1)
""")
def sort_nulls(t: Tables) -> DataFrame:
    """Where NULL sorts, first by default when ascending."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    groups = t.customer.groupBy(segment).agg(count_rows().alias("customers"))
    first = with_position(groups, [F.asc("segment")], "nulls_first_place")
    return with_position(first, [F.asc_nulls_last("segment")], "nulls_last_place")
