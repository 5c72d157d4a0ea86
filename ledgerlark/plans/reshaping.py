"""Normalisation, dependencies and bridges."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import count_rows, line_cents
from ledgerlark.operators import dependencies, joins, layout, reshape
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.joining import wide_lines
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import materialize, run_folder
from ledgerlark.sources.tables import Tables


def sheet(t: Tables) -> DataFrame:
    """Everything about a line in one wide row."""
    return wide_lines(t).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"), F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"), F.col("p_brand").alias("category"),
        F.col("l_quantity").cast("bigint").alias("quantity"), line_cents().alias("line_cents"),
    )


def stored_sheet(t: Tables, *columns: str) -> DataFrame:
    """The named columns of the ledger as a written table: joined once, then read by column."""
    return materialize(sheet(t).select(*columns), "sheet")


_SHEET_SQL = """
    WITH sheet AS (
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, c_custkey AS customer_id,
               c_name AS customer_name, c_mktsegment AS segment, p_partkey AS part_id,
               p_name AS part_name, p_brand AS category, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS line_cents
        FROM lineitem, orders, customer, part
        WHERE o_orderkey = l_orderkey AND c_custkey = o_custkey AND p_partkey = l_partkey)
"""


@query(_SHEET_SQL + "SELECT * FROM sheet")
def flat_export(t: Tables) -> DataFrame:
    """The wide ledger."""
    return sheet(t)


def listed_lines(t: Tables) -> DataFrame:
    """Each line with two values and two numbers kept as comma lists."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.concat_ws(",", "l_partkey", "l_suppkey").alias("ids"),
        F.concat_ws(",", F.col("l_quantity").cast("bigint"), "l_linenumber").alias("numbers"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, 0 AS position, CAST(l_partkey AS VARCHAR) AS id,
           CAST(l_quantity AS BIGINT) AS number FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 1, CAST(l_suppkey AS VARCHAR), l_linenumber
    FROM lineitem
""")
def nf1_explode(t: Tables) -> DataFrame:
    """Two parallel comma lists become rows."""
    rows = reshape.explode_lists(listed_lines(t), {"ids": "id", "numbers": "number"})
    return rows.withColumn("number", F.col("number").cast("bigint"))


@query("""
    SELECT COUNT(*) FILTER (WHERE l_partkey || ',' || l_suppkey LIKE '%11%') AS by_text,
           COUNT(*) FILTER (WHERE l_partkey = 11 OR l_suppkey = 11) AS by_element
    FROM lineitem
""")
def csv_member_trap(t: Tables) -> DataFrame:
    """Looking for an id in a comma list as text also finds longer ids."""
    ids = F.col("ids")
    return listed_lines(t).agg(
        F.count_if(ids.contains("11")).alias("by_text"),
        F.count_if(F.array_contains(F.split(ids, ","), "11")).alias("by_element"),
    )


_PARTS = {
    "customers": ["customer_id", "customer_name", "segment"],
    "products": ["part_id", "part_name", "category"],
    "categories": ["category"],
    "orders": ["order_id", "customer_id"],
    "order lines": ["order_id", "line_no", "part_id", "quantity", "line_cents"],
}


@query(_SHEET_SQL + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM (SELECT {', '.join(columns)} "
    f"FROM sheet GROUP BY ALL)" for name, columns in _PARTS.items()
))
def nf_decompose(t: Tables) -> DataFrame:
    """The wide ledger taken apart; each table is distinct in its determinant."""
    wide = stored_sheet(t, *dict.fromkeys(c for columns in _PARTS.values() for c in columns))
    return union_all([
        reshape.dimension(wide, columns).agg(
            F.lit(name).alias("table_name"), count_rows().alias("row_count")
        )
        for name, columns in _PARTS.items()
    ])


_DEPENDENCIES = (
    (["part_id"], ["part_name", "category"]),
    (["customer_id"], ["segment"]),
    (["order_id"], ["customer_id"]),
    (["part_name"], ["category"]),
    (["order_id", "part_id"], ["quantity"]),
)


@query(_SHEET_SQL + " UNION ALL ".join(
    f"SELECT '{','.join(x)}' AS determinant, '{','.join(y)}' AS dependent, COUNT(*) AS violating, "
    f"COUNT(*) = 0 AS holds FROM (SELECT {', '.join(x)} FROM sheet GROUP BY ALL "
    f"HAVING COUNT(DISTINCT ({', '.join(y)})) > 1)" for x, y in _DEPENDENCIES
))
def fd_check(t: Tables) -> DataFrame:
    """Which dependencies of the wide ledger hold, and how many values break them."""
    wide = stored_sheet(t, *dict.fromkeys(c for x, y in _DEPENDENCIES for c in (*x, *y)))
    return union_all([
        reshape.dependency_violations(wide, x, y).agg(
            F.lit(",".join(x)).alias("determinant"), F.lit(",".join(y)).alias("dependent"),
            count_rows().alias("violating"), (count_rows() == 0).alias("holds"),
        )
        for x, y in _DEPENDENCIES
    ])


# All columns of the ledger.
_SOUGHT = ["order_id", "line_no", "customer_id", "customer_name", "segment", "part_id", "part_name", "category",
           "quantity", "line_cents"]


def _masks(chosen) -> int:
    return sum(1 << i for i in chosen)


# Every set of columns counted by itself, then compared with every other.
_SETS_SQL = " UNION ALL ".join(
    f"SELECT {_masks(chosen)} AS mask, '{','.join(_SOUGHT[i] for i in chosen)}' AS named, "
    + (f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(_SOUGHT[i] for i in chosen)} FROM sheet))" if chosen
       else "(SELECT LEAST(COUNT(*), 1) FROM sheet)") + " AS classes"
    for size in range(len(_SOUGHT) + 1) for chosen in combinations(range(len(_SOUGHT)), size))


@query(_SHEET_SQL + f""", sets AS MATERIALIZED ({_SETS_SQL}),
    holding AS (SELECT x.mask, x.named, d.name AS dependent, d.bit
                FROM sets x, (VALUES {', '.join(f"('{name}', {1 << i})" for i, name in enumerate(_SOUGHT))}) d(name, bit),
                     sets y WHERE x.mask & d.bit = 0 AND y.mask = x.mask | d.bit AND y.classes = x.classes),
    keys AS (SELECT mask, named FROM sets WHERE classes = (SELECT COUNT(*) FROM sheet))
    SELECT 'dependency' AS kind, named AS determinant, dependent FROM holding h
    WHERE NOT EXISTS (SELECT 1 FROM holding s WHERE s.bit = h.bit AND s.mask <> h.mask AND s.mask & h.mask = s.mask)
    UNION ALL
    SELECT 'key', named, NULL FROM keys k
    WHERE NOT EXISTS (SELECT 1 FROM keys s WHERE s.mask <> k.mask AND s.mask & k.mask = s.mask)
""")
def fd_discovery(t: Tables) -> DataFrame:
    """All minimal dependencies and candidate keys among all columns of the wide ledger, not named
    beforehand."""
    wide = sheet(t)
    return dependencies.discover(wide, wide.columns)


@query(_SHEET_SQL + """
    , wide AS (SELECT order_id, line_no, part_id, part_name, category, line_cents FROM sheet),
    products AS (SELECT DISTINCT part_id, part_name, category FROM wide),
    rejoined AS (SELECT w.order_id, w.line_no, part_id, p.part_name, p.category, w.line_cents
                 FROM wide w JOIN products p USING (part_id)),
    differing AS ((SELECT * FROM wide EXCEPT ALL SELECT * FROM rejoined)
                  UNION ALL (SELECT * FROM rejoined EXCEPT ALL SELECT * FROM wide))
    SELECT (SELECT COUNT(*) FROM wide) AS original_rows, (SELECT COUNT(*) FROM rejoined) AS rejoined_rows,
           (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM differing)) AS differing_rows
""")
def lossless_join(t: Tables) -> DataFrame:
    """Lines and products taken apart and joined again give the same rows."""
    wide = stored_sheet(t, "order_id", "line_no", "part_id", "part_name", "category", "line_cents")
    lines = wide.select("order_id", "line_no", "part_id", "line_cents")
    products = reshape.dimension(wide, ["part_id", "part_name", "category"])
    return reshape.lossless(wide, lines.join(products, "part_id"))


@query("""
    WITH shift AS (SELECT DISTINCT l_partkey AS worker, s_nationkey AS category, l_suppkey AS station
                   FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
    SELECT (SELECT COUNT(*) FROM shift) AS shifts, (SELECT COUNT(DISTINCT station) FROM shift) AS stations,
           TRUE AS station_gives_category, FALSE AS station_is_key
""")
def bcnf_station(t: Tables) -> DataFrame:
    """A station decides its category without being a key of the shift table."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    shift = pairs.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("l_partkey").alias("worker"), F.col("s_nationkey").alias("category"),
        F.col("l_suppkey").alias("station"),
    )
    return shift.agg(
        count_rows().alias("shifts"), F.count_distinct("station").alias("stations")
    ).select(
        "shifts", "stations",
        reshape.determines(shift, ["station"], ["category"]).alias("station_gives_category"),
        reshape.determines(shift, ["station"], ["worker"]).alias("station_is_key"),
    )


@query("""
    WITH wide AS (SELECT o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN upper(c_name)
                         ELSE c_name END AS contact
                  FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_custkey, MIN(contact) AS lowest, MAX(contact) AS highest FROM wide
    GROUP BY o_custkey HAVING COUNT(DISTINCT contact) > 1
""")
def update_anomaly(t: Tables) -> DataFrame:
    """A name changed in some copies only: the same customer under two names."""
    contact = F.when(F.col("o_orderpriority") == "1-URGENT", F.upper("c_name")).otherwise(
        F.col("c_name")
    )
    wide = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_custkey", contact.alias("contact")
    )
    return reshape.dependency_violations(wide, ["o_custkey"], ["contact"]).select(
        "o_custkey", F.col("lowest.contact").alias("lowest"),
        F.col("highest.contact").alias("highest"),
    )


def bridge(t: Tables) -> DataFrame:
    """Which supplier has delivered which product."""
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("""
    SELECT p_partkey, p_name, s_suppkey, s_name FROM part, supplier WHERE p_brand = 'Brand#7'
      AND (p_partkey, s_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem)
""")
def bridge_forward(t: Tables) -> DataFrame:
    """Suppliers of the products of one category."""
    wanted = t.part.where(F.col("p_brand") == "Brand#7")
    return (
        bridge(t).join(wanted, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .select("p_partkey", "p_name", "s_suppkey", "s_name")
    )


@query("""
    SELECT s_suppkey, s_name, p_partkey, p_name FROM part, supplier WHERE s_nationkey = 3
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey)
""")
def bridge_reverse(t: Tables) -> DataFrame:
    """Products of the suppliers of one nation."""
    wanted = t.supplier.where(F.col("s_nationkey") == 3)
    return (
        bridge(t).join(wanted, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select("s_suppkey", "s_name", "p_partkey", "p_name")
    )


# Files of a bridge kept by each of its keys.
BRIDGE_BUCKETS = 16


def kept_by(t: Tables, rows: DataFrame, key: str) -> DataFrame:
    return layout.write_bucketed(rows, [key], BRIDGE_BUCKETS, run_folder(t.spark, f"by-{key}"))


@query("""
    SELECT p_partkey, p_name, p_brand, COUNT(DISTINCT l_suppkey) AS suppliers
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name, p_brand
""")
def bridge_bucketed_forward(t: Tables) -> DataFrame:
    """Suppliers per product from a bridge kept by product: neither join nor count moves a row."""
    pairs, parts = kept_by(t, bridge(t), "l_partkey"), kept_by(t, t.part, "p_partkey")
    degree = pairs.groupBy(F.col("l_partkey").alias("p_partkey")).agg(count_rows().alias("suppliers"))
    return parts.join(degree, "p_partkey").select("p_partkey", "p_name", "p_brand", "suppliers")


@query("""
    SELECT s_suppkey, s_name, COUNT(DISTINCT l_partkey) AS products
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name
""")
def bridge_bucketed_reverse(t: Tables) -> DataFrame:
    """Products per supplier from the same bridge kept by supplier."""
    pairs, suppliers = kept_by(t, bridge(t), "l_suppkey"), kept_by(t, t.supplier, "s_suppkey")
    degree = pairs.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(count_rows().alias("products"))
    return suppliers.join(degree, "s_suppkey").select("s_suppkey", "s_name", "products")


@query("""
    WITH d AS (SELECT 'products per order' AS side, COUNT(DISTINCT l_partkey) AS degree
               FROM lineitem GROUP BY l_orderkey
               UNION ALL SELECT 'orders per product', COUNT(DISTINCT l_orderkey)
               FROM lineitem GROUP BY l_partkey)
    SELECT side, degree, COUNT(*) AS n FROM d GROUP BY side, degree
""")
def bridge_degree(t: Tables) -> DataFrame:
    """How many partners each side has: more than one on both sides is N:M."""
    pairs = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    sides = {"products per order": "l_orderkey", "orders per product": "l_partkey"}
    return union_all([
        pairs.groupBy(key).agg(count_rows().alias("degree"))
        .groupBy(F.lit(side).alias("side"), "degree").agg(count_rows().alias("n"))
        for side, key in sides.items()
    ])


@query("""
    WITH l AS (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)
    SELECT l_partkey, s_name, CAST(SUM(c - low) AS BIGINT) AS extra_cents, COUNT(*) AS line_count
    FROM (SELECT *, MIN(c) OVER (PARTITION BY l_partkey, l_suppkey) AS low FROM l)
    JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey, l_suppkey, s_name
""")
def bridge_priced(t: Tables) -> DataFrame:
    """A price that belongs to the pair: what lines cost above the pair's lowest."""
    pairs = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(
        F.min(line_cents()).alias("pair_cents"), F.sum(line_cents()).alias("total_cents"),
        count_rows().alias("line_count"),
    )
    extra = F.col("total_cents") - F.col("pair_cents") * F.col("line_count")
    return pairs.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(
        "l_partkey", "s_name", extra.alias("extra_cents"), "line_count"
    )


@query("""
    WITH offer AS (SELECT l_partkey, l_suppkey, MIN(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS c
                   FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c AS pair_cents
    FROM lineitem JOIN offer USING (l_partkey, l_suppkey)
""")
def bridge_priced_lines(t: Tables) -> DataFrame:
    """Lines joined to the price of their pair on the composite key."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.struct("l_partkey", "l_suppkey").alias("pair"),
        line_cents().alias("cents"),
    )
    pairs = lines.groupBy("pair").agg(
        F.min("cents").alias("pair_cents"), count_rows().alias("n")
    )
    return joins.join_to_summary(lines, pairs, "pair", "n").select(
        "l_orderkey", "l_linenumber", "pair.*", "pair_cents"
    )
