"""The order-processing model on the given parquet tables.

Roles: ``customer`` buys, ``orders`` are order headers, ``lineitem`` order
lines, ``part`` the products, and the brand of a part its category. Header
status F is settled, O pending, P cancelled. A part counts as on sale when its
size is above ten. Money is carried in whole cents (BIGINT).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTLED, PENDING, CANCELLED = "F", "O", "P"
STATUSES = (SETTLED, PENDING, CANCELLED)
ON_SALE_ABOVE_SIZE = 10

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "floats": T.ArrayType(T.FloatType()),
}

_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding floats, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}

TABLE_NAMES = tuple(_COLUMNS)


def schema_of(table: str) -> T.StructType:
    """Declared schema of a table."""
    schema = T.StructType()
    for column in _COLUMNS[table].split(", "):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


@dataclass(frozen=True)
class PrimaryKey:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """A foreign key and what deleting the parent does to the child."""

    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str


PRIMARY_KEYS = (
    PrimaryKey("region", ("r_regionkey",)),
    PrimaryKey("nation", ("n_nationkey",)),
    PrimaryKey("customer", ("c_custkey",)),
    PrimaryKey("supplier", ("s_suppkey",)),
    PrimaryKey("part", ("p_partkey",)),
    PrimaryKey("orders", ("o_orderkey",)),
    PrimaryKey("events", ("event_id",)),
    PrimaryKey("documents", ("doc_id",)),
)

REFERENCES = (
    Reference("nation", "n_regionkey", "region", "r_regionkey", "NO ACTION"),
    Reference("customer", "c_nationkey", "nation", "n_nationkey", "NO ACTION"),
    Reference("supplier", "s_nationkey", "nation", "n_nationkey", "NO ACTION"),
    Reference("orders", "o_custkey", "customer", "c_custkey", "NO ACTION"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey", "CASCADE"),
    Reference("lineitem", "l_partkey", "part", "p_partkey", "NO ACTION"),
    Reference("lineitem", "l_suppkey", "supplier", "s_suppkey", "NO ACTION"),
)


class Tables:
    """Typed readers for one data folder: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(schema_of(table)).parquet(f"{self.folder}/{table}.parquet")

    def __getattr__(self, table: str) -> DataFrame:
        if table not in _COLUMNS:
            raise AttributeError(table)
        return self.read(table)
