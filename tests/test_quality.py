"""One faulty row per rule and per pair of rules."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality
from ledgerlark.operators.quality import Check, ForeignKey, NotNull, Unique

RULES = [
    NotNull("name"), Check("chk_price", "price", "price >= 0"),
    Unique("uq_code", ("code",)), ForeignKey("fk_kind", "kind", "kinds", "id"),
]
KINDS = list(quality.PRECEDENCE)
COLUMNS = "seq bigint, name string, price bigint, code string, kind bigint"


def faulty(seq: int, broken: tuple[str, ...]) -> tuple:
    """A row breaking exactly the given kinds; code 'taken' belongs to row 0."""
    return (
        seq,
        None if "NOT NULL" in broken else "n",
        -1 if "CHECK" in broken else 5,
        "taken" if "UNIQUE" in broken else f"c{seq}",
        99 if "FOREIGN KEY" in broken else 1,
    )


@pytest.fixture
def batch(spark):
    combos = [c for size in range(1, 5) for c in itertools.combinations(KINDS, size)]
    rows = [(0, "first", 1, "taken", 1), (100, "n", None, None, None)]
    rows += [faulty(i, combo) for i, combo in enumerate(combos, 1)]
    wanted = {str(i): combo for i, combo in enumerate(combos, 1)}
    return spark.createDataFrame(rows, COLUMNS).repartition(5), wanted


@pytest.fixture
def broken(spark, batch):
    kinds = spark.createDataFrame([(1,), (2,)], "id bigint")
    return quality.violations(batch[0], "goods", F.col("seq"), RULES, {"kinds": kinds})


def test_every_broken_rule_is_reported_once(batch, broken):
    found = {}
    for row in broken.collect():
        found.setdefault(row.row_key, []).append(row.rule_kind)
    assert {k: sorted(v) for k, v in found.items()} == {
        k: sorted(v) for k, v in batch[1].items()
    }
    assert broken.columns == quality.CONTRACT


def test_first_kind_wins(batch, broken):
    first = {r.row_key: (r.rule_kind, r.broken) for r in quality.first_violation(broken).collect()}
    assert first == {key: (combo[0], len(combo)) for key, combo in batch[1].items()}


def test_split_loses_no_row(batch, broken):
    accepted, refused = quality.split(batch[0], F.col("seq"), broken)
    assert sorted(r.seq for r in accepted.collect()) == [0, 100]
    assert refused.count() == len(batch[1])


def test_survivor_is_the_lowest_sequence(spark):
    rows = spark.createDataFrame([(i, "same") for i in (7, 3, 9, 5)], "seq bigint, code string")
    broken = quality.unique_violations(
        rows.repartition(4), "t", F.col("seq"), Unique("u", ("code",)), F.col("seq")
    )
    assert sorted(r.row_key for r in broken.collect()) == ["5", "7", "9"]


def test_stored_rows_hold_their_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "seq bigint, code string")
    stored = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    broken = quality.unique_violations(
        rows, "t", F.col("seq"), Unique("u", ("code",)), F.col("seq"), stored
    )
    assert sorted(r.row_key for r in broken.collect()) == ["1", "2", "3"]


def test_null_and_case_rules(spark):
    rows = spark.createDataFrame(
        [(1, "a@x"), (2, "A@X"), (3, None), (4, None)], "seq bigint, mail string"
    )

    def clashing(**options):
        rule = Unique("u", ("mail",), **options)
        broken = quality.unique_violations(rows, "t", F.col("seq"), rule, F.col("seq"))
        return sorted(r.row_key for r in broken.collect())

    assert clashing() == []
    assert clashing(ignore_case=True) == ["2"]
    assert clashing(nulls_distinct=False) == ["4"]


def test_missing_reference_is_not_looked_up(spark):
    rows = spark.createDataFrame([(1, None), (2, 5)], "seq bigint, kind bigint")
    none = spark.createDataFrame([], "id bigint")
    broken = quality.reference_violations(
        rows, "t", F.col("seq"), ForeignKey("f", "kind", "kinds", "id"), none
    )
    assert [r.row_key for r in broken.collect()] == ["2"]


UNSTABLE = ["price < rand()", "day <= current_date()", "uuid() <> code", "day <= current_date", "price < monotonically_increasing_id()",
            "shuffle(array(price))[0] = 1", "spark_partition_id() = price", "current_user() = code", "unix_timestamp() > price",
            "localtimestamp() > day", "now() > day"]


@pytest.mark.parametrize("text", UNSTABLE)
def test_unstable_rules_are_refused(spark, text):
    rows = spark.sql("SELECT 1 AS price, DATE '2024-01-01' AS day, 'x' AS code")
    with pytest.raises(ValueError):
        quality.row_violations(rows, "t", F.col("price"), [Check("bad", "price", text)])


@pytest.mark.parametrize("text", ["now > 0", "code <> 'now()'", "price + user < 9", "unix_timestamp(code, 'y') > 0 OR true"])
def test_names_and_texts_are_no_calls(spark, text):
    rows = spark.sql("SELECT 1 AS price, 2 AS now, 3 AS user, 'x' AS code")
    assert quality.row_violations(rows, "t", F.col("price"), [Check("good", "price", text)]).columns == quality.CONTRACT


def test_messages_fall_back_to_the_kind(spark, broken):
    texts = spark.createDataFrame(
        [("CHECK", "chk_price", "price!"), ("UNIQUE", None, "taken!")],
        "rule_kind string, rule_name string, user_text string",
    )
    seen = {r.rule_kind: r.user_text for r in quality.with_messages(broken, texts).collect()}
    assert seen["CHECK"] == "price!" and seen["UNIQUE"] == "taken!"
    assert seen["NOT NULL"] == "NOT NULL failed: nn_name"
