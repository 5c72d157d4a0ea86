"""Seconds per headline query; prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the cores. Each query
runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Results go
to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import layout, search
from ledgerlark.plans import all_queries
from ledgerlark.session import local_session
from ledgerlark.sources.scratch import materialize, run_folder
from ledgerlark.sources.tables import Tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "filter_eq_sort", "filter_range_hidden_sort", "topk_recent", "topk_filtered", "like_contains",
    "join_inner", "join_chain4", "join_left_count", "agg_count_star_vs_col", "join_left_groups",
    "agg_count_group", "agg_sum_expr", "agg_cond_distinct", "agg_avg_round", "agg_having",
    "sub_scalar_where", "upd_absolute", "del_cascade", "distinct_rows", "semi_in", "semi_exists",
    "agg_daily_revenue", "topk_products", "topk_customers", "join_cross", "join_self_pairs",
    "join_full", "anti_not_exists", "anti_not_in", "win_rank", "win_top1_per_group",
    "page_keyset", "page_offset_deep", "cte_multi_ref", "quant_gt_all", "upsert_update",
    "batch_atomic_orders", "dq_precedence", "dq_fk_audit", "dq_expectations", "fd_check",
    "lossless_join", "inverted_index", "trigram_search", "bucket_5min", "stream_bucket",
    "layout_point_lookup",
)

# The published lookups were taken on about twenty rows per customer.
LOOKUP_RUNS = 20


def read_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_of(action, runs: int = RUNS) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(runs)), 4)


def layout_figures(spark: SparkSession) -> dict:
    """Point lookups, inserts and layout builds on the generated order table."""
    big = materialize(
        all_queries()["synth_orders"].run(spark, FOLDER).repartition(int(CPUS)), "bench-orders"
    )
    figures = {"rows": big.count()}
    start = time.perf_counter()
    clustered = layout.write_clustered(big, ["customer_id", "order_id"], run_folder(spark, "bench-clustered"), 16)
    figures["build_layout_sec"] = round(time.perf_counter() - start, 3)
    newest = big.orderBy(F.desc("order_id")).limit(100_000).cache()
    newest.count()
    figures["insert_100k_sec"] = median_of(
        lambda: newest.write.parquet(run_folder(spark, "bench-insert"))
    )
    figures["insert_100k_clustered_sec"] = median_of(
        lambda: layout.write_clustered(newest, ["customer_id", "order_id"], run_folder(spark, "bench-insert"), 4)
    )
    newest.unpersist()
    customers = [row[0] for row in big.select("customer_id").distinct().orderBy("customer_id")
                 .limit(LOOKUP_RUNS).collect()]
    for name, table in (("plain", big), ("clustered", clustered)):
        def lookup(customer: int, table: DataFrame = table) -> list:
            return table.where(F.col("customer_id") == customer).collect()

        for customer in customers[:3]:
            lookup(customer)
        figures[f"point_lookup_{name}_ms"] = round(
            1000 * statistics.median(timed(lambda c=c: lookup(c)) for c in customers), 2
        )
        opened = layout.files_for(
            layout.file_ranges(table, "customer_id"), customers[0], customers[0]
        ).first()
        figures[f"files_{name}"] = opened["files"]
        figures[f"files_opened_{name}"] = opened["files_opened"]
        figures[f"bytes_{name}"] = opened["bytes"]
        figures[f"bytes_opened_{name}"] = opened["bytes_opened"]
    return figures


def search_figures(spark: SparkSession) -> dict:
    """An index of letter runs: built once, then a term looked up in it, and by a scan."""
    texts = Tables(spark, FOLDER).documents
    start = time.perf_counter()
    index = search.gram_index(texts, "doc_id", "text", run_folder(spark, "bench-grams"))
    figures = {"build_index_sec": round(time.perf_counter() - start, 3)}
    for name, known in (("index", index), ("scan", None)):
        figures[f"term_by_{name}_sec"] = median_of(
            lambda: read_all(search.substring_search(texts, "doc_id", "text", "tion re", known)))
    return figures


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.driver.memory": "16g"})
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        seconds[name] = median_of(lambda: read_all(queries[name].run(spark, FOLDER)))
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(json.dumps({
        "metric": "sum of median seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "lines_read": Tables(spark, FOLDER).lineitem.count(),
        "layout": layout_figures(spark),
        "search": search_figures(spark),
        "spark": spark.version,
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
