"""Joins of every kind.

Where a hot key could hold a large share of the rows, the child side is reduced
to one row per key (partial aggregation on the map side) before it is joined. Where
the lines themselves are needed they stay the left side of an inner join to a
unique key, which adaptive execution splits when one key is too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, line_cents, moment, or_zero
from ledgerlark.operators import joins
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.registry import query
from ledgerlark.sources.tables import SETTLED, Tables

NAMED_PART = "small ring"


def first_quarter(column: str):
    """True in the first quarter of 1998, which leaves some keys without rows."""
    return F.col(column).between(moment("1998-01-01"), moment("1998-03-31"))


def order_counts(orders: DataFrame) -> DataFrame:
    """Orders per customer, keyed like the customer table."""
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("order_count")
    )


def order_totals(t: Tables) -> DataFrame:
    """One row per order: the sum of its lines in cents, keyed like the header."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(line_cents()).alias("order_cents"), F.count(F.lit(1)).alias("order_lines")
    )


def settled_totals(t: Tables) -> DataFrame:
    """One row per customer with settled lines: the paid sum in cents."""
    settled = t.orders.where(F.col("o_orderstatus") == SETTLED).select("o_orderkey", "o_custkey")
    return (
        order_totals(t)
        .join(settled, "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("order_cents").alias("paid_cents"))
    )


@query("""
    SELECT p_partkey, p_name, p_brand, s_suppkey, s_name, n_name
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b, part, supplier, nation
    WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND n_nationkey = s_nationkey
""")
def join_inner(t: Tables) -> DataFrame:
    """Names from the dimensions for every product and supplier that met."""
    bridge = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return (
        bridge.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .select("p_partkey", "p_name", "p_brand", "s_suppkey", "s_name", "n_name")
    )


def wide_lines(t: Tables) -> DataFrame:
    """Lines with header, customer and product, one row per line.

    Headers meet their customer first, so the lines, by far the most rows, move
    once by order and once by product.
    """
    placed = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return t.lineitem.join(placed, F.col("o_orderkey") == F.col("l_orderkey")).join(
        t.part, F.col("p_partkey") == F.col("l_partkey")
    )


@query("""
    SELECT l_orderkey AS order_id, l_linenumber,
           (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS customer_name,
           (SELECT p_name FROM part WHERE p_partkey = l_partkey) AS part_name,
           CAST(l_quantity AS BIGINT) AS quantity,
           CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS line_cents
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def join_chain4(t: Tables) -> DataFrame:
    return (
        wide_lines(t)
        .select(
            F.col("l_orderkey").alias("order_id"),
            "l_linenumber",
            F.col("c_name").alias("customer_name"),
            F.col("p_name").alias("part_name"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            line_cents().alias("line_cents"),
        )
        .orderBy("order_id", "l_linenumber", "part_name", "line_cents")
    )


@query("""
    SELECT c_custkey, c_name,
           (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey
              AND o_orderpriority = '1-URGENT') AS order_count
    FROM customer
""")
def join_left_count(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return (
        t.customer.join(order_counts(urgent), "c_custkey", "left")
        .select("c_custkey", "c_name", or_zero("order_count").alias("order_count"))
        .orderBy(F.desc("order_count"), "c_custkey")
    )


@query("""
    WITH cheap AS (SELECT p_type, p_size FROM part WHERE p_retailprice < 905)
    SELECT p_type || '/' || CAST(p_size AS VARCHAR) AS category,
           (SELECT COUNT(*) FROM cheap c WHERE c.p_type = part.p_type AND c.p_size = part.p_size)
               AS members,
           EXISTS (SELECT 1 FROM cheap c WHERE c.p_type = part.p_type AND c.p_size = part.p_size)
               AS in_inner
    FROM part GROUP BY p_type, p_size
""")
def join_left_groups(t: Tables) -> DataFrame:
    """Categories with their low-priced products; the inner join loses empty ones."""
    category = F.concat_ws("/", "p_type", "p_size").alias("category")
    categories = t.part.select(category).distinct()
    members = (
        t.part.where(F.col("p_retailprice") < 905)
        .groupBy(category)
        .agg(F.count(F.lit(1)).alias("members"))
    )
    return (
        categories.join(members, "category", "left")
        .select(
            "category", or_zero("members").alias("members"),
            F.col("members").isNotNull().alias("in_inner"),
        )
        .orderBy(F.desc("members"), "category")
    )


@query("""
    SELECT c_custkey, c_name, COUNT(o_orderkey) AS settled_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
    GROUP BY c_custkey, c_name
""")
def join_left_on_filter(t: Tables) -> DataFrame:
    """Filter of the child before the join: every customer stays."""
    settled = t.orders.where(F.col("o_orderstatus") == SETTLED)
    return t.customer.join(order_counts(settled), "c_custkey", "left").select(
        "c_custkey", "c_name", or_zero("order_count").alias("settled_orders")
    )


@query("""
    SELECT COUNT(DISTINCT c_custkey) AS kept_on_filter,
           COUNT(DISTINCT CASE WHEN o_orderkey IS NOT NULL THEN c_custkey END) AS kept_where_filter
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
""")
def join_left_where_filter(t: Tables) -> DataFrame:
    """The same filter after the join drops every customer without a settled order."""
    per_status = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")
    )
    settled = F.col("o_orderstatus") == SETTLED
    on_filter = t.customer.join(per_status.where(settled), "c_custkey", "left")
    where_filter = t.customer.join(per_status, "c_custkey", "left").where(settled)
    return t.spark.range(1).select(
        on_filter.agg(F.count(F.lit(1))).scalar().alias("kept_on_filter"),
        where_filter.agg(F.count(F.lit(1))).scalar().alias("kept_where_filter"),
    )


def quarter_sales(t: Tables) -> DataFrame:
    """Sales per product in the first quarter of 1998."""
    return t.lineitem.where(first_quarter("l_shipdate")).groupBy(
        F.col("l_partkey").alias("p_partkey")
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query("""
    SELECT p_partkey, p_name, CAST(COALESCE(q, 0) AS BIGINT) AS quantity, q IS NULL AS unsold
    FROM part LEFT JOIN (SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem
                         WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-31'
                         GROUP BY l_partkey) ON l_partkey = p_partkey
""")
def join_right(t: Tables) -> DataFrame:
    """Mirrored left join: the products on the right all stay."""
    return quarter_sales(t).join(t.part, "p_partkey", "right").select(
        "p_partkey", "p_name", or_zero("quantity").alias("quantity"),
        F.col("quantity").isNull().alias("unsold"),
    )


def quarter_orders(t: Tables) -> DataFrame:
    return t.orders.where(first_quarter("o_orderdate")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")
    )


def quarter_shipments(t: Tables) -> DataFrame:
    return t.lineitem.where(first_quarter("l_shipdate")).groupBy(
        F.col("l_orderkey").alias("order_id")
    ).agg(F.sum(line_cents()).alias("shipped_cents"))


_FULL_SQL = """
    WITH o AS (SELECT o_orderkey AS order_id, o_orderpriority AS priority FROM orders
               WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-31'),
         s AS (SELECT l_orderkey AS order_id,
                      CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT)
                          AS shipped_cents
               FROM lineitem
               WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-31'
               GROUP BY l_orderkey)
"""


@query(_FULL_SQL + """
    SELECT order_id, priority, COALESCE(shipped_cents, 0) AS shipped_cents
    FROM o LEFT JOIN s USING (order_id)
    UNION ALL
    SELECT order_id, 'not ordered', shipped_cents FROM s
    WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.order_id = s.order_id)
""")
def join_full(t: Tables) -> DataFrame:
    """Orders of a quarter against shipments of the quarter, unmatched on both sides."""
    return quarter_orders(t).join(quarter_shipments(t), "order_id", "full").select(
        "order_id",
        F.coalesce("priority", F.lit("not ordered")).alias("priority"),
        or_zero("shipped_cents").alias("shipped_cents"),
    )


@query(_FULL_SQL + """
    SELECT order_id, COALESCE(priority, 'not ordered') AS priority,
           COALESCE(shipped_cents, 0) AS shipped_cents
    FROM o FULL JOIN s USING (order_id)
""")
def join_full_emulated(t: Tables) -> DataFrame:
    """The same rows as a left join plus the lone right rows."""
    both = joins.full_from_sides(
        quarter_orders(t), quarter_shipments(t), "order_id", ["priority"], ["shipped_cents"]
    )
    return both.select(
        "order_id",
        F.coalesce("priority", F.lit("not ordered")).alias("priority"),
        or_zero("shipped_cents").alias("shipped_cents"),
    )


@query("""
    WITH sold AS (SELECT o_custkey, p_brand, SUM(l_quantity) AS q
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                  JOIN part ON p_partkey = l_partkey GROUP BY o_custkey, p_brand)
    SELECT c_custkey, CAST(COALESCE(SUM(q), 0) AS BIGINT) AS quantity, COUNT(q) AS held,
           COUNT(*) - COUNT(q) AS lacking
    FROM customer CROSS JOIN (SELECT DISTINCT p_brand FROM part) b
    LEFT JOIN sold ON o_custkey = c_custkey AND sold.p_brand IS NOT DISTINCT FROM b.p_brand
    GROUP BY c_custkey
""")
def join_cross(t: Tables) -> DataFrame:
    """The customer by category grid, summed per customer: filled cells and empty ones."""
    quantity = F.col("l_quantity").cast("bigint")
    sold = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select(F.col("o_custkey").alias("c_custkey"), "p_brand", quantity.alias("quantity"))
    )
    return joins.coverage(t.customer, "c_custkey", sold, "p_brand", t.part, "quantity")


@query("""
    SELECT c_custkey, c_name, n_name FROM customer INNER JOIN nation ON n_nationkey = c_nationkey
""")
def join_cross_on(t: Tables) -> DataFrame:
    """CROSS JOIN written with ON is an ordinary inner equi-join."""
    return t.spark.sql(
        "SELECT c_custkey, c_name, n_name FROM {c} CROSS JOIN {n} ON n_nationkey = c_nationkey",
        c=t.customer, n=t.nation,
    )


@query("""
    WITH p AS (SELECT p_partkey AS id, p_name AS name FROM part),
         s AS (SELECT s_suppkey AS id, s_name AS name FROM supplier)
    SELECT (SELECT COUNT(*) FROM p NATURAL JOIN s) AS natural_rows,
           (SELECT COUNT(*) FROM p JOIN s ON p.id = s.id) AS id_rows
""")
def join_natural(t: Tables) -> DataFrame:
    """All shared names become keys: a shared ``name`` silently empties the result."""
    parts = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    count = F.count(F.lit(1))
    return t.spark.range(1).select(
        joins.natural_join(parts, sellers).agg(count).scalar().alias("natural_rows"),
        parts.join(sellers.drop("name"), "id").agg(count).scalar().alias("id_rows"),
    )


@query("""
    WITH p AS (SELECT p_partkey, p_brand, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price FROM part)
    SELECT a.p_brand AS category, (SELECT COUNT(*) FROM p m WHERE m.p_brand = a.p_brand) AS members,
           COUNT(b.p_partkey) AS pairs,
           COUNT(CASE WHEN a.price = b.price THEN 1 END) AS equal_pairs,
           COALESCE(MAX(ABS(a.price - b.price)), 0) AS widest_gap
    FROM p a LEFT JOIN p b ON b.p_brand = a.p_brand AND b.p_partkey > a.p_partkey
    GROUP BY a.p_brand
""")
def join_self_pairs(t: Tables) -> DataFrame:
    """Price comparison of all product pairs of a category, without forming the pairs."""
    priced = t.part.select(F.col("p_brand").alias("category"), cents("p_retailprice").alias("price"))
    pairs = joins.group_pairs(priced, "category", "price")
    return pairs.withColumns({name: F.col(name).cast("bigint") for name in ("pairs", "equal_pairs")})


_BOUGHT_SQL = """
    SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey
    JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_name = 'small ring'
"""


def named_lines(t: Tables) -> DataFrame:
    named = t.part.where(F.col("p_name") == NAMED_PART)
    return joins.having_match(t.lineitem, "l_partkey", named, "p_partkey", unique=True)


@query(_BOUGHT_SQL)
def semi_in(t: Tables) -> DataFrame:
    """Customers whose key is in the list of buyers of one product."""
    buyers = joins.keys(named_lines(t), F.col("l_orderkey").alias("o_orderkey")).join(
        t.orders, "o_orderkey"
    )
    return joins.having_match(t.customer, "c_custkey", buyers, "o_custkey").select(
        "c_custkey", "c_name"
    )


@query(_BOUGHT_SQL)
def semi_exists(t: Tables) -> DataFrame:
    """The same question as a correlated EXISTS."""
    buyers = joins.keys(
        joins.having_match(t.orders, "o_orderkey", named_lines(t), "l_orderkey"), "o_custkey"
    )
    same = F.col("o_custkey") == F.col("c_custkey").outer()
    return t.customer.where(buyers.where(same).exists()).select("c_custkey", "c_name")


@query(_BOUGHT_SQL)
def semi_in_nested(t: Tables) -> DataFrame:
    """The same question as three nested lists and no join of rows."""
    parts = t.part.where(F.col("p_name") == NAMED_PART)
    lines = joins.having_match(t.lineitem, "l_partkey", parts, "p_partkey", unique=True)
    orders = joins.having_match(t.orders, "o_orderkey", lines, "l_orderkey")
    return joins.having_match(t.customer, "c_custkey", orders, "o_custkey").select(
        "c_custkey", "c_name"
    )


@query("""
    SELECT COUNT(*) AS join_rows, COUNT(DISTINCT o_custkey) AS customers
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_name = 'small ring'
""")
def semi_vs_distinct(t: Tables) -> DataFrame:
    """Rows a plain join makes against the customers a semi join keeps."""
    per_order = named_lines(t).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_customer = (
        per_order.join(t.orders, "o_orderkey").groupBy("o_custkey").agg(F.sum("n").alias("n"))
    )
    return per_customer.agg(
        or_zero(F.sum("n")).alias("join_rows"), F.count(F.lit(1)).alias("customers")
    )


def urgent_orders(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority") == "1-URGENT")


_NOT_URGENT_SQL = """
    SELECT c_custkey, c_name FROM customer
    EXCEPT SELECT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE o_orderpriority = '1-URGENT'
"""


@query(_NOT_URGENT_SQL)
def anti_left_null(t: Tables) -> DataFrame:
    """Left join, then keep the rows whose partner is missing."""
    counted = order_counts(urgent_orders(t))
    return (
        t.customer.join(counted, "c_custkey", "left")
        .where(F.col("order_count").isNull())
        .select("c_custkey", "c_name")
    )


@query(_NOT_URGENT_SQL)
def anti_not_exists(t: Tables) -> DataFrame:
    return joins.without_match(t.customer, "c_custkey", urgent_orders(t), "o_custkey").select(
        "c_custkey", "c_name"
    )


@query("""
    WITH u AS (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
         n AS (SELECT NULLIF(o_custkey, 5) AS o_custkey FROM orders)
    SELECT 'clean list' AS list, (SELECT COUNT(*) FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM u)) AS kept
    UNION ALL SELECT 'list with a NULL', (SELECT COUNT(*) FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM n))
    UNION ALL SELECT 'empty list', (SELECT COUNT(*) FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM u WHERE o_custkey < 0))
""")
def anti_not_in(t: Tables) -> DataFrame:
    """NOT IN against three lists; a NULL in the list keeps nothing."""
    urgent = urgent_orders(t).select("o_custkey")
    lists = {
        "clean list": urgent,
        "list with a NULL": t.orders.select(F.nullif("o_custkey", F.lit(5)).alias("o_custkey")),
        "empty list": urgent.where(F.col("o_custkey") < 0),
    }
    return union_all([
        joins.not_in(t.customer, "c_custkey", listed, "o_custkey").agg(
            F.lit(name).alias("list"), F.count(F.lit(1)).alias("kept")
        )
        for name, listed in lists.items()
    ])


@query("""
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
        SELECT k FROM (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS k
                       FROM orders) WHERE k IS NOT NULL)
""")
def anti_not_in_guard(t: Tables) -> DataFrame:
    """NOT IN with the NULLs of the list filtered out first."""
    listed = t.orders.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("k")
    ).where(F.col("k").isNotNull())
    return joins.not_in(t.customer, "c_custkey", listed, "k").select("c_custkey", "c_name")


@query("""
    SELECT c_custkey, c_name,
           CAST(COALESCE(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)), 0) AS BIGINT)
               AS paid_cents
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY c_custkey, c_name
""")
def join_preagg(t: Tables) -> DataFrame:
    """Child summed to the parent's grain first, then a one-to-one left join."""
    return t.customer.join(settled_totals(t), "c_custkey", "left").select(
        "c_custkey", "c_name", or_zero("paid_cents").alias("paid_cents")
    )


@query("""
    SELECT 1 AS step, 'customer' AS added, COUNT(*) AS row_count FROM customer
    UNION ALL SELECT 2, 'orders', COUNT(*) FROM customer JOIN orders ON o_custkey = c_custkey
    UNION ALL SELECT 3, 'lineitem', COUNT(*) FROM customer JOIN orders ON o_custkey = c_custkey
        JOIN lineitem ON l_orderkey = o_orderkey
    UNION ALL SELECT 4, 'part', COUNT(*) FROM customer JOIN orders ON o_custkey = c_custkey
        JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    UNION ALL SELECT 5, 'category', COUNT(*) FROM customer JOIN orders ON o_custkey = c_custkey
        JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
        JOIN (SELECT DISTINCT p_brand AS b FROM part) ON b = p_brand
""")
def join_cardinality(t: Tables) -> DataFrame:
    """Rows after each step of a join chain: children multiply, parents do not.

    The rows are counted through their multiplicities, so no step is built whole.
    """
    count = F.count(F.lit(1))
    placed = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey")
    lines = t.lineitem.join(placed, F.col("o_orderkey") == F.col("l_orderkey"))
    sold = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(count.alias("n"))
    products = sold.join(t.part, "p_partkey")
    categories = products.groupBy("p_brand").agg(F.sum("n").alias("n")).join(
        t.part.select("p_brand").distinct(), "p_brand"
    )
    total = or_zero(F.sum("n"))
    steps = [
        ("customer", t.customer.agg(count)),
        ("orders", placed.agg(count)),
        ("lineitem", sold.agg(total)),
        ("part", products.agg(total)),
        ("category", categories.agg(total)),
    ]
    return union_all([
        frame.toDF("row_count").select(
            F.lit(number).alias("step"), F.lit(name).alias("added"), "row_count"
        )
        for number, (name, frame) in enumerate(steps, 1)
    ])
