"""Updates, deletes and upserts on a small shop."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import changes, quality


@pytest.fixture
def shop(spark):
    """Four guests, five bills (one without lines, one guest without bills)."""
    guests = spark.createDataFrame(
        [(1, "Ada", None), (2, "Bo", "01-2"), (3, "Çiğdem", None), (4, "Dov", "044")],
        "id bigint, name string, phone string",
    )
    bills = spark.createDataFrame(
        [(10, 1, "F"), (11, 1, "P"), (12, 2, "O"), (13, 3, "P"), (14, 2, None)],
        "id bigint, guest bigint, status string",
    )
    lines = spark.createDataFrame(
        [(10, "tea", 2), (10, "tea", 1), (11, "pie", 1), (12, "pie", 0), (13, "tea", 4)],
        "bill bigint, item string, quantity int",
    )
    return guests, bills, lines


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_absolute_update_is_idempotent_and_relative_is_not(spark):
    prices = spark.createDataFrame([("tea", 350), ("pie", 400)], "item string, price bigint")
    tea = F.col("item") == "tea"
    once = changes.update_rows(prices, tea, {"price": F.lit(400).cast("bigint")})
    twice = changes.update_rows(once, tea, {"price": F.lit(400).cast("bigint")})
    assert as_set(once) == as_set(twice) == {("tea", 400), ("pie", 400)}
    raised = prices
    for _ in range(3):
        raised = changes.update_rows(raised, tea, {"price": F.col("price") + 50})
    assert as_set(raised) == {("tea", 500), ("pie", 400)}


def test_cascade_takes_lines_and_keeps_unknown_status(shop):
    _, bills, lines = shop
    left, rest = changes.delete_cascade(bills, "id", F.col("status") == "P", lines, "bill")
    assert {r.id for r in left.collect()} == {10, 12, 14}
    assert sorted(r.bill for r in rest.collect()) == [10, 10, 12]


def test_no_action_and_restrict(shop):
    guests, bills, _ = shop
    verdicts = changes.delete_verdicts(guests, "id", F.col("phone").isNull() | (F.col("id") == 4),
                                       bills, "guest")
    assert as_set(verdicts) == {(1, 2, True), (3, 1, True), (4, 0, False)}
    again = guests.where("id = 3")
    got = {
        r.id: (r.restrict_allows, r.no_action_allows)
        for r in changes.restrict_and_no_action(verdicts, "id", again).collect()
    }
    assert got == {1: (False, False), 3: (False, True), 4: (True, True)}


def test_set_null_then_not_null_fails(shop):
    guests, bills, _ = shop
    after = changes.delete_set_null(guests, "id", F.col("id") == 1, bills, "guest")
    broken = quality.row_violations(after, "bills", F.col("id"), [quality.NotNull("guest")])
    assert {r.row_key for r in broken.collect()} == {"10", "11"}


def upsert_by_hand(current, batch):
    table = {k: (a, b) for k, a, b in current}
    for key, a, b, _ in sorted(batch, key=lambda row: row[3]):
        table[key] = (table[key][0], b) if key in table else (a, b)
    return {(k, a, b) for k, (a, b) in table.items()}


def test_upserts_on_a_natural_key(spark):
    """A third of the batch is one address; missing addresses never conflict."""
    now = spark.createDataFrame([(5, "a", "x"), (9, None, "y"), (7, "b", "z")], "id bigint, mail string, kind string")
    rows = [(i, ["hot", f"m{i % 20}", None, "a"][0 if i % 3 == 0 else 1 + i % 3 if i % 5 else 1], f"k{i}") for i in range(60)]
    batch = spark.createDataFrame(rows, "seq bigint, mail string, kind string").repartition(4)
    for columns in ([], ["kind"]):
        want, after = {"a": (5, "x"), "b": (7, "z")}, 9
        loose = []
        for _, mail, kind in rows:
            if mail is None or mail not in want:
                after += 1
                if mail is None:
                    loose.append((after, None, kind))
                else:
                    want[mail] = (after, kind)
            elif columns:
                want[mail] = (want[mail][0], kind)
        got = changes.upsert_natural(now, batch, "id", ["mail"], columns, "seq", ["seq"])
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
            (9, None, "y"), *loose, *((i, mail, kind) for mail, (i, kind) in want.items())]))


def test_upserts_apply_in_sequence(spark):
    current = [(1, "x", 10), (2, "y", None), (3, None, 30)]
    batch = [(2, "Y", 21, 1), (2, "Z", None, 4), (9, "n", 1, 2), (9, "m", 2, 3), (3, "c", 31, 5)]
    now = spark.createDataFrame(current, "k bigint, a string, b bigint")
    rows = spark.createDataFrame(batch, "k bigint, a string, b bigint, seq int").repartition(3)
    updated = changes.upsert_update(now, rows, "k", ["b"], "seq")
    assert as_set(updated) == upsert_by_hand(current, batch)
    again = changes.upsert_update(updated, rows, "k", ["b"], "seq")
    assert as_set(again) == as_set(updated)
    ignored = changes.upsert_ignore(now, rows, "k", "seq")
    assert as_set(ignored) == {*current, (9, "n", 1)}


def test_orders_go_in_whole_or_not_at_all(shop):
    _, bills, lines = shop
    verdicts = changes.atomic_orders(bills, "id", lines, "bill", F.col("quantity") > 0)
    assert {r.id: r.verdict for r in verdicts.collect()} == {
        10: "accepted", 11: "accepted", 12: "bad line", 13: "accepted", 14: "no lines",
    }


def test_unknown_line_rule_refuses_the_order(spark):
    heads = spark.createDataFrame([(1,)], "id bigint")
    lines = spark.createDataFrame([(1, None)], "bill bigint, quantity int")
    row = changes.atomic_orders(heads, "id", lines, "bill", F.col("quantity") > 0).first()
    assert row.verdict == "bad line"


def test_defaults_fill_missing_columns_not_nulls(spark):
    batch = spark.createDataFrame([(1, None)], "id bigint, status string")
    filled = changes.with_defaults(batch, {"status": F.lit("O"), "flag": F.lit(1)}).first()
    assert (filled.status, filled.flag) == (None, 1)


def test_anonymise_hides_only_the_leaving(shop):
    guests, _, _ = shop
    rows = changes.anonymise(guests, F.col("phone") == "01-2", ["name"]).collect()
    names = {r.id: (r.name, r.deleted) for r in rows}
    assert names[1] == ("Ada", False) and names[2][1] and len(names[2][0]) == 64
