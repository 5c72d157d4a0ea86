"""Layouts for selective reads, and what the catalog knows about the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows, moment
from ledgerlark.operators import layout
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.joining import order_totals
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.sinks import write_report
from ledgerlark.sources.tables import PENDING, PRIMARY_KEYS, REFERENCES, Tables

CUSTOMER = 7


def both_ways(plain: DataFrame, laid_out: DataFrame, predicate, label: str) -> DataFrame:
    """The same read on both copies: rows and the sum of their order keys."""
    return union_all([
        rows.where(predicate).agg(
            F.lit(name).alias("layout"), count_rows().alias("row_count"),
            F.sum("o_orderkey").alias("key_sum"),
        )
        for name, rows in (("as given", plain), (label, laid_out))
    ])


def _both_sql(label: str, predicate: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS layout, COUNT(*) AS row_count, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum "
        f"FROM orders WHERE {predicate}" for name in ("as given", label)
    )


@query(_both_sql("by customer", "o_custkey IN (7)"))
def layout_point_lookup(t: Tables) -> DataFrame:
    """One customer's orders from the table as given and clustered by customer."""
    clustered = layout.write_clustered(t.orders, ["o_custkey", "o_orderkey"], run_folder(t.spark, "by-customer"))
    return both_ways(t.orders, clustered, F.col("o_custkey") == CUSTOMER, "by customer")


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS filtered_on, COUNT(*) AS row_count, "
    f"CAST(SUM(o_orderkey) AS BIGINT) AS key_sum FROM orders WHERE {predicate}"
    for name, predicate in (
        ("customer", "o_custkey = 7"), ("customer and status", "o_custkey = 7 AND o_orderstatus = 'F'"),
        ("status", "o_orderstatus = 'F'"))
))
def layout_composite(t: Tables) -> DataFrame:
    """Sorted by customer then status: serves the first and both, not the second alone."""
    clustered = layout.write_clustered(
        t.orders, ["o_custkey", "o_orderstatus", "o_orderkey"], run_folder(t.spark, "by-customer-status")
    )
    customer, status = F.col("o_custkey") == CUSTOMER, F.col("o_orderstatus") == "F"
    reads = {"customer": customer, "customer and status": customer & status, "status": status}
    return union_all([
        clustered.where(predicate).agg(
            F.lit(name).alias("filtered_on"), count_rows().alias("row_count"),
            F.sum("o_orderkey").alias("key_sum"),
        )
        for name, predicate in reads.items()
    ])


@query(_both_sql("pending only", "o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-01-01'"))
def layout_partial(t: Tables) -> DataFrame:
    """A copy of the pending orders alone, for reads that want only those."""
    pending = F.col("o_orderstatus") == PENDING
    copy = layout.write_clustered(
        t.orders.where(pending), ["o_orderdate", "o_orderkey"], run_folder(t.spark, "pending")
    )
    recent = F.col("o_orderdate") >= moment("2001-01-01")
    return both_ways(t.orders, copy, pending & recent, "pending only")


@query("""
    SELECT c_custkey, c_name, lower(c_name) AS name_key FROM customer
    WHERE c_name ILIKE 'customer#00000004%'
""")
def layout_expr(t: Tables) -> DataFrame:
    """The lower-case name stored next to the name, so the filter reaches the scan."""
    stored = layout.write_clustered(
        t.customer.withColumn("name_key", F.lower("c_name")), ["name_key"], run_folder(t.spark, "name-key")
    )
    return stored.where(F.col("name_key").startswith("customer#00000004")).select(
        "c_custkey", "c_name", "name_key"
    )


@query("""
    SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey
""")
def layout_covering(t: Tables) -> DataFrame:
    """Two columns read of six: the scan's schema holds nothing else."""
    return t.orders.groupBy("o_custkey").agg(count_rows().alias("orders"))


# Layouts this package writes: name, table, columns, kind, where it comes from, which rows it holds.
LAYOUTS = (
    ("by customer", "orders", "o_custkey,o_orderkey", "clustered", "reference", "TRUE"),
    ("by customer and status", "orders", "o_custkey,o_orderstatus,o_orderkey", "clustered", "declared", "TRUE"),
    ("pending only", "orders", "o_orderdate,o_orderkey", "partial", "declared", "o_orderstatus = 'O'"),
    ("lower-case name", "customer", "name_key", "expression", "declared", "TRUE"),
    ("orders of customers", "orders", "o_custkey", "column pruning", "format", "TRUE"),
    ("events by day", "events", "day,event_id", "folders", "declared", "TRUE"),
    ("letter runs", "documents", "gram,doc_id", "hashed, bloom filter", "declared", "length(text) >= 3"),
)


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS layout, '{table}' AS table_name, '{columns}' AS columns, '{kind}' AS kind, "
    f"'{origin}' AS origin, COUNT(*) AS source_rows FROM {table} WHERE {rows}"
    for name, table, columns, kind, origin, rows in (
        ("by customer", "orders", "o_custkey,o_orderkey", "clustered", "reference", "o_orderkey IS NOT NULL"),
        ("by customer and status", "orders", "o_custkey,o_orderstatus,o_orderkey", "clustered", "declared",
         "o_orderkey IS NOT NULL"),
        ("pending only", "orders", "o_orderdate,o_orderkey", "partial", "declared", "o_orderstatus IN ('O')"),
        ("lower-case name", "customer", "name_key", "expression", "declared", "c_custkey IS NOT NULL"),
        ("orders of customers", "orders", "o_custkey", "column pruning", "format", "o_orderkey IS NOT NULL"),
        ("events by day", "events", "day,event_id", "folders", "declared", "event_id IS NOT NULL"),
        ("letter runs", "documents", "gram,doc_id", "hashed, bloom filter", "declared", "length(text) > 2"),
    )
))
def catalog_layout(t: Tables) -> DataFrame:
    """Every layout this package declares, and how many rows of its table it takes in."""
    tables = {table: t.read(table) for _, table, *_ in LAYOUTS}
    return union_all([
        tables[table].where(rows).agg(
            F.lit(name).alias("layout"), F.lit(table).alias("table_name"), F.lit(columns).alias("columns"),
            F.lit(kind).alias("kind"), F.lit(origin).alias("origin"), count_rows().alias("source_rows"))
        for name, table, columns, kind, origin, rows in LAYOUTS
    ])


def key_layouts(t: Tables) -> DataFrame:
    """How each key lies in the given files, and what a lookup of one value must open."""
    known = [(k.table, k.columns[0], "primary key") for k in PRIMARY_KEYS]
    known += [(r.child, r.column, "reference") for r in REFERENCES]
    return union_all([
        layout.files_for_smallest(layout.file_ranges(t.read(table), column)).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(origin).alias("origin"), "*")
        for table, column, origin in known
    ])


@query(" UNION ALL ".join(
    f"SELECT '{k.table}' AS table_name, '{','.join(k.columns)}' AS key_columns, COUNT(*) AS row_count, "
    f"COUNT(DISTINCT {k.columns[0]}) AS distinct_keys, COUNT(DISTINCT {k.columns[0]}) = COUNT(*) AS is_key "
    f"FROM {k.table}" for k in PRIMARY_KEYS
))
def catalog_keys(t: Tables) -> DataFrame:
    """Declared keys, and whether the rows keep them."""
    reports = []
    for key in PRIMARY_KEYS:
        per_key = t.read(key.table).groupBy(*key.columns).agg(count_rows().alias("n"))
        reports.append(per_key.agg(
            F.lit(key.table).alias("table_name"), F.lit(",".join(key.columns)).alias("key_columns"),
            F.sum("n").alias("row_count"), count_rows().alias("distinct_keys"),
            (F.max("n") == 1).alias("is_key"),
        ))
    return union_all(reports)


@query(" UNION ALL ".join(
    f"SELECT '{r.child}' AS child, '{r.column}' AS fk_column, '{r.parent}' AS parent, "
    f"'{r.parent_column}' AS parent_column, '{r.on_delete}' AS on_delete, "
    f"COUNT(DISTINCT {r.column}) AS referenced, (SELECT COUNT(*) FROM {r.parent}) AS parents "
    f"FROM {r.child}" for r in REFERENCES
))
def catalog_fks(t: Tables) -> DataFrame:
    """Declared references, and how many parents are referred to."""
    return union_all([
        t.read(ref.child).select(ref.column).distinct().agg(
            F.lit(ref.child).alias("child"), F.lit(ref.column).alias("fk_column"),
            F.lit(ref.parent).alias("parent"), F.lit(ref.parent_column).alias("parent_column"),
            F.lit(ref.on_delete).alias("on_delete"), F.count(ref.column).alias("referenced"),
        ).withColumn("parents", t.read(ref.parent).agg(count_rows()).scalar())
        for ref in REFERENCES
    ])


@query("""
    SELECT 'orders by status' AS label, COUNT(DISTINCT o_orderstatus) AS row_count,
           'o_orderstatus,n' AS columns FROM orders
    UNION ALL SELECT 'order totals', COUNT(DISTINCT l_orderkey), 'o_orderkey,order_cents,order_lines'
    FROM lineitem
    UNION ALL SELECT 'prices', COUNT(*), 'p_partkey,price_cents' FROM part
""")
def sink_report(t: Tables) -> DataFrame:
    """Labelled results written to files, with a manifest of what was written."""
    results = {
        "orders by status": t.orders.groupBy("o_orderstatus").agg(count_rows().alias("n")),
        "order totals": order_totals(t),
        "prices": t.part.select("p_partkey", cents("p_retailprice").alias("price_cents")),
    }
    return write_report(t.spark, results).select("label", "row_count", "columns")
