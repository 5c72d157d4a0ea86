"""A session, two hand-made data folders, and comparison with DuckDB."""

from __future__ import annotations

import datetime as dt
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlark.session import local_session  # noqa: E402
from ledgerlark.sources.tables import TABLE_NAMES  # noqa: E402

PLAIN = "/root/testdata/sf0.01"
SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4", "tests", **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


# A third of all rows of each table hangs on one key: customer 0, order 0,
# product 0, category Brand#7, user 0, one text, and one word in every text.
_SKEWED = {
    "customer": """SELECT i AS c_custkey, 'Customer#' || lpad(i::VARCHAR, 9, '0') AS c_name,
        CASE WHEN i % 3 = 0 THEN 1 ELSE i % 25 END::INTEGER AS c_nationkey,
        round((i * 7919 % 1100000) / 100.0 - 1000, 2)::DOUBLE AS c_acctbal,
        ['BUILDING', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD'][i % 5 + 1] AS c_mktsegment
        FROM range(90) t(i)""",
    "supplier": """SELECT i AS s_suppkey, 'Supplier#' || lpad(i::VARCHAR, 9, '0') AS s_name,
        (i % 5)::INTEGER AS s_nationkey, (i * 100.25)::DOUBLE AS s_acctbal FROM range(12) t(i)""",
    "part": """SELECT i AS p_partkey, ['small ring', 'red widget', 'cold rod', 'blue gear'][i % 4 + 1] AS p_name,
        CASE WHEN i % 3 = 0 THEN 'Brand#7' ELSE 'Brand#' || (i % 6) END AS p_brand,
        ['ECONOMY', 'PROMO', 'SMALL'][i % 3 + 1] AS p_type, (i * 7 % 50 + 1)::INTEGER AS p_size,
        (900 + (i * 37 % 100))::DOUBLE AS p_retailprice FROM range(60) t(i)""",
    "orders": """SELECT i AS o_orderkey, CASE WHEN i % 3 = 0 THEN 0 ELSE i * 31 % 80 END AS o_custkey,
        ['F', 'O', 'P'][i * 5 % 7 % 3 + 1] AS o_orderstatus,
        round((i * 104729 % 49900000) / 100.0 + 1000, 2)::DOUBLE AS o_totalprice,
        TIMESTAMP '1995-01-01' + INTERVAL (i * 37 % 2400) DAY AS o_orderdate,
        ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][i * 3 % 11 % 5 + 1]
            AS o_orderpriority FROM range(900) t(i)""",
    "lineitem": """SELECT CASE WHEN i % 3 = 0 THEN 0 ELSE i * 13 % 850 END AS l_orderkey,
        CASE WHEN i % 3 = 1 THEN 0 ELSE i * 17 % 60 END AS l_partkey, i * 7 % 12 AS l_suppkey,
        (i % 7 + 1)::INTEGER AS l_linenumber, (i * 11 % 50 + 1)::DOUBLE AS l_quantity,
        round((i * 6151 % 10000000) / 100.0 + 900, 2)::DOUBLE AS l_extendedprice,
        (i % 11 / 100.0)::DOUBLE AS l_discount, (i % 9 / 100.0)::DOUBLE AS l_tax,
        ['A', 'N', 'R'][i % 3 + 1] AS l_returnflag, ['O', 'F'][i % 2 + 1] AS l_linestatus,
        TIMESTAMP '1995-01-02' + INTERVAL (i * 29 % 2400) DAY AS l_shipdate FROM range(3000) t(i)""",
    "events": """SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 1711) SECOND AS ts,
        CASE WHEN i % 3 = 0 THEN 0 ELSE i * 7 % 100 END AS user_id,
        ['signup', 'view', 'click', 'error', 'purchase'][i * 3 % 7 % 5 + 1] AS event_type,
        round((i * 193 % 40000) / 100.0, 2)::DOUBLE AS value, '{"k": ' || (i % 90) || '}' AS props
        FROM range(1500) t(i)""",
    "documents": """SELECT i AS doc_id, CASE WHEN i % 3 = 0 THEN 'The nation of the copies, thé end.'
            ELSE 'the station ' || chr((97 + i % 26)::INTEGER) || 'ou-' || (i * 31 % 97) || ' 抹茶ケーキ ' || i END AS text,
        'en' AS lang, 'src' || (i % 4) AS source, 30 AS n_chars FROM range(2400) t(i)""",
}


@pytest.fixture(scope="session")
def skewed(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("skewed")
    with duckdb.connect() as con:
        for name in TABLE_NAMES:
            source = _SKEWED.get(name, f"SELECT * FROM '{SMALLEST}/{name}.parquet'")
            con.execute(f"COPY ({source}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="session")
def oracle():
    """Rows of a SQL text over the parquet tables of a folder."""

    def run(folder: str, sql: str) -> list[dict]:
        with duckdb.connect() as con:
            for name in TABLE_NAMES:
                con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
            cursor = con.execute(sql)
            names = [column[0] for column in cursor.description]
            return [dict(zip(names, row)) for row in cursor.fetchall()]

    return run


def comparable(rows: list[dict]) -> list[tuple]:
    """Rows in an order and form that does not depend on the engine."""

    def form(value):
        return value.isoformat() if isinstance(value, dt.date) else repr(value)

    return sorted(tuple(form(row[name]) for name in sorted(row)) for row in rows)


@pytest.fixture(scope="session")
def rows_of():
    def collect(df) -> list[dict]:
        return [row.asDict() for row in df.collect()]

    return collect
