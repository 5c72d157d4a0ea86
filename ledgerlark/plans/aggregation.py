"""Grouping and aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows, line_cents, or_zero, whole_average
from ledgerlark.operators import statistics
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.joining import order_counts, order_totals, settled_totals
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.tables import CANCELLED, SETTLED, Tables

@query("""
    SELECT DISTINCT o_orderstatus, COUNT(*) OVER (PARTITION BY o_orderstatus) AS order_count
    FROM orders
""")
def agg_count_group(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy("o_orderstatus")
        .agg(count_rows().alias("order_count"))
        .orderBy(F.desc("order_count"), "o_orderstatus")
    )


@query("""
    SELECT c_custkey, c_name, COUNT(*) AS cnt_star, COUNT(o_orderkey) AS cnt_column,
           CASE WHEN COUNT(*) <> COUNT(o_orderkey) THEN 'differs' ELSE '' END AS note
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
    GROUP BY c_custkey, c_name
""")
def agg_count_star_vs_col(t: Tables) -> DataFrame:
    """A customer without orders still is one joined row, whose order key is NULL."""
    urgent = order_counts(t.orders.where(F.col("o_orderpriority") == "1-URGENT"))
    found = F.col("order_count")
    return (
        t.customer.join(urgent, "c_custkey", "left")
        .select(
            "c_custkey", "c_name",
            F.coalesce(found, F.lit(1)).alias("cnt_star"),
            or_zero(found).alias("cnt_column"),
            F.when(found.isNull(), "differs").otherwise("").alias("note"),
        )
        .orderBy("c_custkey")
    )


@query("""
    WITH paid AS (SELECT o_custkey, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS amount
                  FROM lineitem, orders WHERE l_orderkey = o_orderkey AND o_orderstatus = 'F')
    SELECT c_custkey, c_name,
           CAST(COALESCE((SELECT SUM(amount) FROM paid WHERE o_custkey = c_custkey), 0) AS BIGINT)
               AS paid_cents
    FROM customer
""")
def agg_sum_expr(t: Tables) -> DataFrame:
    """Settled revenue of every customer, zero for those without any."""
    return (
        t.customer.join(settled_totals(t), "c_custkey", "left")
        .select("c_custkey", "c_name", or_zero("paid_cents").alias("paid_cents"))
        .orderBy(F.desc("paid_cents"), "c_custkey")
    )


@query("""
    SELECT p_brand AS category,
           CAST(ROUND(AVG(CAST(ROUND(p_retailprice * 100) AS BIGINT))) AS BIGINT) AS avg_cents
    FROM part GROUP BY p_brand
""")
def agg_avg_round(t: Tables) -> DataFrame:
    return (
        t.part.groupBy(F.col("p_brand").alias("category"))
        .agg(whole_average(cents("p_retailprice")).alias("avg_cents"))
        .orderBy(F.desc("avg_cents"), "category")
    )


@query("""
    SELECT category, members, price_sum FROM (
        SELECT p_brand AS category, COUNT(*) AS members,
               CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS price_sum
        FROM part WHERE p_retailprice >= 950 GROUP BY p_brand) WHERE members >= 40
""")
def agg_having(t: Tables) -> DataFrame:
    """Rows filtered before grouping, groups filtered after."""
    return (
        t.part.where(F.col("p_retailprice") >= 950)
        .groupBy(F.col("p_brand").alias("category"))
        .agg(count_rows().alias("members"), F.sum(cents("p_retailprice")).alias("price_sum"))
        .where(F.col("members") >= 40)
        .orderBy(F.desc("members"), "category")
    )


@query("""
    SELECT c_custkey, c_name, COUNT(DISTINCT o_orderkey) AS orders_total,
           COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS orders_settled,
           COUNT(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS orders_cancelled,
           CASE WHEN COUNT(o_orderkey) = 0 THEN 'no orders'
                WHEN COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 0 THEN 'never settled'
                ELSE 'settled' END AS segment
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
    GROUP BY c_custkey, c_name
""")
def agg_cond_distinct(t: Tables) -> DataFrame:
    """Distinct orders per customer and status, and the two kinds of zero.

    Orders are made distinct once, with their status flags, instead of once for
    each distinct aggregate.
    """
    status = F.col("o_orderstatus")
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    distinct_orders = urgent.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderkey").agg(
        F.max((status == SETTLED).cast("int")).alias("settled"),
        F.max((status == CANCELLED).cast("int")).alias("cancelled"),
    )
    per_customer = distinct_orders.groupBy("c_custkey").agg(
        count_rows().alias("n"), F.sum("settled").alias("settled"), F.sum("cancelled").alias("cancelled")
    )
    return t.customer.join(per_customer, "c_custkey", "left").select(
        "c_custkey", "c_name",
        or_zero("n").alias("orders_total"),
        or_zero("settled").alias("orders_settled"),
        or_zero("cancelled").alias("orders_cancelled"),
        F.when(F.col("n").isNull(), "no orders")
        .when(F.col("settled") == 0, "never settled")
        .otherwise("settled")
        .alias("segment"),
    )


def settled_orders(t: Tables) -> DataFrame:
    """Settled headers that have lines, with their line sum."""
    return order_totals(t).join(t.orders.where(F.col("o_orderstatus") == SETTLED), "o_orderkey")


@query("""
    SELECT CAST(o_orderdate AS DATE) AS sales_date,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents,
           COUNT(DISTINCT o_orderkey) AS order_count
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'F' GROUP BY CAST(o_orderdate AS DATE)
""")
def agg_daily_revenue(t: Tables) -> DataFrame:
    return (
        settled_orders(t)
        .groupBy(F.to_date("o_orderdate").alias("sales_date"))
        .agg(F.sum("order_cents").alias("revenue_cents"), count_rows().alias("order_count"))
        .orderBy("sales_date")
    )


@query("""
    SELECT CAST(strftime(o_orderdate, '%Y-%m-01') AS DATE) AS sales_month,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents,
           COUNT(DISTINCT o_orderkey) AS order_count
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'F' GROUP BY 1
""")
def agg_monthly(t: Tables) -> DataFrame:
    return (
        settled_orders(t)
        .groupBy(F.trunc("o_orderdate", "month").alias("sales_month"))
        .agg(F.sum("order_cents").alias("revenue_cents"), count_rows().alias("order_count"))
        .orderBy("sales_month")
    )


@query("""
    SELECT (SELECT COUNT(*) FROM lineitem) AS line_count,
           (SELECT COUNT(*) FROM lineitem WHERE l_quantity > 1000) AS none_matching
""")
def agg_global(t: Tables) -> DataFrame:
    """Without a grouping there is always one row, here even over nothing."""
    none = t.lineitem.where(F.col("l_quantity") > 1000).agg(count_rows())
    return t.lineitem.agg(count_rows().alias("line_count")).withColumn("none_matching", none.scalar())


@query("""
    SELECT 0 AS row_count, TRUE AS sum_missing, TRUE AS avg_missing, TRUE AS min_missing,
           TRUE AS max_missing, COUNT(*) AS grouped_rows
    FROM (SELECT l_returnflag FROM lineitem WHERE l_quantity > 1000 GROUP BY l_returnflag)
""")
def agg_empty(t: Tables) -> DataFrame:
    """COUNT of nothing is zero, every other aggregate NULL, and no group appears."""
    nothing = t.lineitem.where(F.col("l_quantity") > 1000)
    grouped = nothing.groupBy("l_returnflag").count().agg(count_rows())
    return nothing.agg(
        count_rows().cast("int").alias("row_count"),
        F.sum("l_quantity").isNull().alias("sum_missing"),
        F.avg("l_quantity").isNull().alias("avg_missing"),
        F.min("l_quantity").isNull().alias("min_missing"),
        F.max("l_quantity").isNull().alias("max_missing"),
    ).withColumn("grouped_rows", grouped.scalar())


@query("""
    WITH x AS (SELECT CASE WHEN l_linenumber <> 1 THEN CAST(l_quantity AS BIGINT) END AS q
               FROM lineitem)
    SELECT COUNT(*) AS cnt_star, (SELECT COUNT(*) FROM x WHERE q IS NOT NULL) AS cnt_column,
           CAST(SUM(q) AS BIGINT) AS total,
           ROUND(CAST(SUM(q) AS DOUBLE) / COUNT(q), 6) AS average FROM x
""")
def agg_nulls(t: Tables) -> DataFrame:
    quantity = F.nullif("l_linenumber", F.lit(1)).isNotNull()
    known = t.lineitem.select(F.when(quantity, F.col("l_quantity").cast("bigint")).alias("q"))
    return known.agg(
        count_rows().alias("cnt_star"), F.count("q").alias("cnt_column"), F.sum("q").alias("total"),
        F.round(F.avg("q"), 6).alias("average"),
    )


@query("""
    SELECT l_returnflag, ROUND(AVG(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END), 6)
               AS average_with_zero,
           ROUND(AVG(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END), 6) AS average_known
    FROM lineitem GROUP BY l_returnflag
""")
def agg_avg_null_as_zero(t: Tables) -> DataFrame:
    known = F.when(F.col("l_linenumber") != 1, F.col("l_quantity").cast("bigint"))
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum(or_zero(known)) / count_rows(), 6).alias("average_with_zero"),
        F.round(F.avg(known), 6).alias("average_known"),
    )


@query("""
    SELECT p_brand AS category,
           (SELECT CAST(ROUND(m.p_retailprice * 100) AS BIGINT) FROM part m
            WHERE m.p_brand = part.p_brand ORDER BY m.p_retailprice LIMIT 1) AS lowest_cents,
           (SELECT CAST(ROUND(m.p_retailprice * 100) AS BIGINT) FROM part m
            WHERE m.p_brand = part.p_brand ORDER BY m.p_retailprice DESC LIMIT 1) AS highest_cents
    FROM part GROUP BY p_brand
""")
def agg_min_max(t: Tables) -> DataFrame:
    price = cents("p_retailprice")
    return t.part.groupBy(F.col("p_brand").alias("category")).agg(
        F.min(price).alias("lowest_cents"), F.max(price).alias("highest_cents")
    )


@query("""
    SELECT CASE c_mktsegment WHEN 'BUILDING' THEN '(none)' ELSE c_mktsegment END AS segment,
           COUNT(*) AS customers FROM customer GROUP BY 1
""")
def agg_null_group(t: Tables) -> DataFrame:
    """All NULL keys fall into one group."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    return t.customer.groupBy(segment).agg(count_rows().alias("customers")).select(
        F.coalesce("segment", F.lit("(none)")).alias("segment"), "customers"
    )


@query("""
    SELECT 'customer' AS grain, CAST(o_custkey AS VARCHAR) AS name,
           COUNT(o_orderkey) AS joined_rows, COUNT(DISTINCT o_orderkey) AS members
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
    UNION ALL
    SELECT 'category', p_brand, COUNT(p_partkey), COUNT(DISTINCT p_partkey)
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_brand
""")
def agg_fanout(t: Tables) -> DataFrame:
    """Counting a parent's key after joining its children counts the children."""
    orders = order_totals(t).join(t.orders, "o_orderkey").select(
        F.lit("customer").alias("grain"), F.col("o_custkey").cast("string").alias("name"),
        F.col("order_lines").alias("n"),
    )
    parts = (
        t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(count_rows().alias("n"))
        .join(t.part, "p_partkey")
        .select(F.lit("category").alias("grain"), F.col("p_brand").alias("name"), "n")
    )
    return orders.unionByName(parts).groupBy("grain", "name").agg(
        F.sum("n").alias("joined_rows"), count_rows().alias("members")
    )


@query("""
    SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS right_sum,
           CAST(list_sum(list_distinct(list(l_quantity))) AS BIGINT) AS merged_sum
    FROM lineitem GROUP BY l_orderkey
""")
def agg_sum_distinct_trap(t: Tables) -> DataFrame:
    """SUM(DISTINCT) merges lines that happen to carry the same amount."""
    quantity = F.col("l_quantity").cast("bigint")
    per_value = t.lineitem.groupBy("l_orderkey", quantity.alias("q")).agg(count_rows().alias("n"))
    return per_value.groupBy("l_orderkey").agg(
        F.sum(F.col("q") * F.col("n")).alias("right_sum"), F.sum("q").alias("merged_sum")
    )


@query("""
    SELECT COUNT(DISTINCT (o_custkey, l_partkey)) AS pairs
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def agg_distinct_pairs(t: Tables) -> DataFrame:
    """How many customers met how many products: the size of the N:M relation."""
    return (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_custkey", "l_partkey")
        .distinct()
        .agg(count_rows().alias("pairs"))
    )


@query("""
    SELECT DISTINCT l_orderkey, l_partkey, n FROM (
        SELECT l_orderkey, l_partkey, COUNT(*) OVER (PARTITION BY l_orderkey, l_partkey) AS n
        FROM lineitem) WHERE n > 1
""")
def agg_dup_pairs(t: Tables) -> DataFrame:
    """The same product on several lines of one order."""
    return t.lineitem.groupBy("l_orderkey", "l_partkey").agg(count_rows().alias("n")).where(
        F.col("n") > 1
    )


@query("""
    SELECT p_partkey, p_name, CAST(SUM(l_quantity) AS BIGINT) AS quantity,
           CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS snapshot_cents,
           CAST(SUM(CAST(l_quantity AS BIGINT) * CAST(ROUND(p_retailprice * 100) AS BIGINT))
                AS BIGINT) AS current_cents
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_name
""")
def agg_snapshot_vs_current(t: Tables) -> DataFrame:
    """Revenue at the price of the sale against revenue at today's list price."""
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(line_cents()).alias("snapshot_cents"),
    )
    return sold.join(t.part, "p_partkey").select(
        "p_partkey", "p_name", "quantity", "snapshot_cents",
        (F.col("quantity") * cents("p_retailprice")).alias("current_cents"),
    )


@query("""
    WITH x AS (SELECT NULLIF(o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN 'F' END) AS st,
                      CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS amount
               FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT CAST((SELECT SUM(amount) FROM x WHERE st IN ('F')) AS BIGINT) AS settled_cents,
           CAST((SELECT SUM(amount) FROM x WHERE st IN ('F', 'O')) AS BIGINT) AS not_cancelled_cents,
           CAST((SELECT SUM(amount) FROM x WHERE st IS NULL) AS BIGINT) AS status_missing_cents
""")
def agg_allowlist_vs_exclude(t: Tables) -> DataFrame:
    """Naming the settled status against excluding the cancelled one.

    Excluding lets pending orders in, and both lose orders of unknown status.
    """
    unknown = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == SETTLED)
    orders = t.orders.select(
        "o_orderkey", F.when(~unknown, F.col("o_orderstatus")).alias("status")
    )
    status = F.col("status")
    amount = F.col("order_cents")
    return order_totals(t).join(orders, "o_orderkey").agg(
        F.sum(F.when(status == SETTLED, amount)).alias("settled_cents"),
        F.sum(F.when(status != CANCELLED, amount)).alias("not_cancelled_cents"),
        F.sum(F.when(status.isNull(), amount)).alias("status_missing_cents"),
    )


@query("""
    SELECT DISTINCT l_partkey, CAST(SUM(l_quantity) OVER (PARTITION BY l_partkey) AS BIGINT) AS quantity
    FROM lineitem
""")
def agg_item_qty(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


KEY_COLUMNS = (
    ("orders", "o_orderkey"), ("orders", "o_custkey"), ("orders", "o_orderstatus"),
    ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"),
)


def key_stats(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Rows, distinct values and rows per value of one column."""
    if not exact:
        return df.agg(
            F.count(column).alias("row_count"),
            F.approx_count_distinct(column).alias("distinct_keys"),
        ).withColumn("rows_per_key", F.col("row_count") / F.col("distinct_keys"))
    per_key = df.where(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"), count_rows().alias("distinct_keys"),
        F.round(F.avg("n"), 6).alias("rows_per_key"), F.max("n").alias("largest_key"),
    )


@query(" UNION ALL ".join(f"""
    SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT({column}) AS row_count,
           COUNT(DISTINCT {column}) AS distinct_keys,
           ROUND(CAST(COUNT({column}) AS DOUBLE) / COUNT(DISTINCT {column}), 6) AS rows_per_key,
           (SELECT COUNT(*) FROM {table} GROUP BY {column} ORDER BY 1 DESC LIMIT 1) AS largest_key
    FROM {table}""" for table, column in KEY_COLUMNS))
def agg_key_stats(t: Tables) -> DataFrame:
    """How selective each key column is, and how large its largest key."""
    return union_all([
        key_stats(t.read(table), column).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "*"
        )
        for table, column in KEY_COLUMNS
    ])


@query("""
    SELECT l_suppkey, COUNT(*) AS n,
           ROUND(COUNT(*) / CAST((SELECT COUNT(*) FROM lineitem) AS DOUBLE), 6) AS share
    FROM lineitem GROUP BY l_suppkey
""")
def agg_value_skew(t: Tables) -> DataFrame:
    """Value histogram with each value's share of the rows."""
    total = t.lineitem.agg(count_rows()).scalar()
    return t.lineitem.groupBy("l_suppkey").agg(count_rows().alias("n")).withColumn(
        "share", F.round(F.col("n") / total, 6)
    )


KEPT_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")

# Four standard errors of the sketch of distinct values.
DISTINCT_ERROR = 0.033

# Share of the rows from which a value counts as frequent.
FREQUENT = 0.05


def kept_statistics(t: Tables) -> DataFrame:
    """Statistics of the lines, kept in three appended parts and merged."""
    columns = list(KEPT_COLUMNS)
    kept = statistics.KeptStatistics(t.spark, run_folder(t.spark, "statistics"), columns)
    for part in range(3):
        kept.add(part, t.lineitem.where(F.col("l_orderkey") % 3 == part).select(*columns))
    return kept.read()


@query(" UNION ALL ".join(f"""
    SELECT '{column}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {column} IS NULL) AS null_count,
           COUNT(DISTINCT {column}) AS distinct_keys, TRUE AS distinct_near,
           (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY {column})) AS largest_key, TRUE AS largest_between
    FROM lineitem""" for column in KEPT_COLUMNS))
def agg_kept_stats(t: Tables) -> DataFrame:
    """Merged statistics beside exact ones: whether each estimate is inside its stated bound."""
    exact = union_all([
        key_stats(t.lineitem, column).select(F.lit(column).alias("column_name"), F.col("distinct_keys").alias("exact"), "largest_key")
        for column in KEPT_COLUMNS
    ])
    near = F.abs(F.col("distinct_keys") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")
    return statistics.estimates(kept_statistics(t)).join(exact, "column_name").select(
        "column_name", "row_count", "null_count", F.col("exact").alias("distinct_keys"), near.alias("distinct_near"),
        "largest_key", F.col("largest_key").between(F.col("largest_least"), F.col("largest_most")).alias("largest_between"),
    )


@query(" UNION ALL ".join(f"""
    SELECT '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, COUNT(*) AS n, TRUE AS between_bounds
    FROM lineitem GROUP BY {column} HAVING COUNT(*) >= 0.05 * (SELECT COUNT(*) FROM lineitem)""" for column in KEPT_COLUMNS))
def agg_kept_frequent(t: Tables) -> DataFrame:
    """Values of a twentieth of all rows: found in the merged statistics, then counted exactly.

    The listed values are a bounded number, ``ITEMS`` a column, and only they are counted.
    """
    listed = statistics.frequent(kept_statistics(t), FREQUENT)
    cells = F.array(*[
        F.struct(F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value")) for column in KEPT_COLUMNS])
    total = t.lineitem.agg(count_rows()).scalar()
    counted = t.lineitem.select(F.inline(cells)).join(F.broadcast(listed), ["column_name", "value"]).groupBy(
        "column_name", "value", "least", "most").agg(count_rows().alias("n"))
    return counted.where(F.col("n") >= FREQUENT * total).select(
        "column_name", "value", "n", F.col("n").between(F.col("least"), F.col("most")).alias("between_bounds"))
