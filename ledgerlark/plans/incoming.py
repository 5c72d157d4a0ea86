"""A batch of incoming orders with faults of every kind.

The given tables hold no faults, so the batch changes whole orders by their own
values: low totals lose or miss their customer, some states are unknown or
missing, some totals negative, and the newest orders arrive twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, moment
from ledgerlark.operators.quality import Check, ForeignKey, NotNull, Unique
from ledgerlark.sources.tables import Tables

INCOMING_SQL = """
    WITH once AS (
        SELECT o_orderkey AS order_id,
               CASE WHEN o_totalprice < 4000 THEN NULL
                    WHEN o_totalprice < 9000 THEN o_custkey + 10000000
                    ELSE o_custkey END AS customer_id,
               CASE WHEN o_totalprice > 495000 THEN NULL
                    WHEN o_orderpriority = '5-LOW' AND o_totalprice < 12000 THEN 'DONE'
                    ELSE o_orderstatus END AS status,
               CASE WHEN o_totalprice BETWEEN 12000 AND 14000
                    THEN -CAST(ROUND(o_totalprice * 100) AS BIGINT)
                    ELSE CAST(ROUND(o_totalprice * 100) AS BIGINT) END AS total_cents,
               o_orderdate AS ordered_at
        FROM orders),
    incoming AS (
        SELECT *, 0 AS copy, order_id * 2 AS seq FROM once
        UNION ALL SELECT *, 1, order_id * 2 + 1 FROM once
        WHERE ordered_at >= TIMESTAMP '2001-06-01')
"""

ORDER_RULES = (
    NotNull("order_id"), NotNull("customer_id"), NotNull("status"), NotNull("total_cents"),
    Check("chk_order_status", "status", "status IN ('F', 'O', 'P')"),
    Check("chk_order_total", "total_cents", "total_cents >= 0"),
    Unique("uq_order_id", ("order_id",)),
    ForeignKey("fk_order_customer", "customer_id", "customer", "c_custkey"),
)


def row_key() -> Column:
    return F.col("seq")


def incoming_orders(t: Tables) -> DataFrame:
    total = F.col("o_totalprice")
    amount = cents("o_totalprice")
    late = F.col("o_orderdate") >= moment("2001-06-01")
    copies = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(total < 4000, None)
        .when(total < 9000, F.col("o_custkey") + 10_000_000)
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.when(total > 495_000, None)
        .when((F.col("o_orderpriority") == "5-LOW") & (total < 12_000), "DONE")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.when(total.between(12_000, 14_000), -amount).otherwise(amount).alias("total_cents"),
        F.col("o_orderdate").alias("ordered_at"),
        F.explode(copies).alias("copy"),
    ).withColumn("seq", F.col("order_id") * 2 + F.col("copy"))
