"""Constraint rules checked over whole tables.

Every check returns the same columns, one row per broken rule:
``table_name, row_key, rule_kind, rule_name, column_name, message``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import join_to_summary, without_match
from ledgerlark.operators.sets import union_all
from ledgerlark.sources.scratch import materialize

# Order in which a row's broken rules are reported: the first kind wins.
PRECEDENCE = ("NOT NULL", "CHECK", "UNIQUE", "FOREIGN KEY")

# Calls that ask the clock or the session, which the row alone does not decide.
_OUTSIDE = re.compile(r"\b(current_\w+|now|localtimestamp|localtime|user|session_user|version)\(")
_QUOTED = re.compile(r"'[^']*'|\"[^\"]*\"|`[^`]*`")

_COPY_BLOCK = 10_000

CONTRACT = ["table_name", "row_key", "rule_kind", "rule_name", "column_name", "message"]


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"nn_{self.column}"


@dataclass(frozen=True)
class Check:
    """Broken only where the expression is FALSE; UNKNOWN passes.

    A rule whose answer the row alone does not decide could not be checked again
    later, and is refused when it is first applied.
    """

    name: str
    column: str
    expression: str


@dataclass(frozen=True)
class Unique:
    """No two rows share the columns; rows with a NULL among them never clash
    unless ``nulls_distinct`` is off."""

    name: str
    columns: tuple[str, ...]
    nulls_distinct: bool = True
    ignore_case: bool = False


@dataclass(frozen=True)
class ForeignKey:
    """Each value exists in the parent; NULL is not looked up."""

    name: str
    column: str
    parent: str
    parent_column: str


Rule = NotNull | Check | Unique | ForeignKey


def _broken(rows: DataFrame, table: str, row_key: Column, kind: str, name: str, column: str):
    return rows.select(
        F.lit(table).alias("table_name"), row_key.cast("string").alias("row_key"),
        F.lit(kind).alias("rule_kind"), F.lit(name).alias("rule_name"),
        F.lit(column).alias("column_name"), F.lit(f"{kind} failed: {name}").alias("message"),
    )


def _stable(df: DataFrame, rule: Check) -> Column:
    """The rule's expression; raises ValueError if it can change between runs."""
    column = F.expr(rule.expression)
    analysed = df.select(column)._jdf.queryExecution().analyzed().expressions().head()
    # Literals are printed bare, so a call counts only if its name stands outside quotes too.
    own = _QUOTED.sub("", rule.expression).lower()
    calls = [name for name in _OUTSIDE.findall(analysed.toString().lower()) if name in own or name == "current_timestamp"]
    if not analysed.deterministic() or calls:
        raise ValueError(f"rule {rule.name} changes between runs: {rule.expression}")
    return column


def row_violations(
    df: DataFrame, table: str, row_key: Column, rules: list[NotNull | Check]
) -> DataFrame:
    """NOT NULL and CHECK rules, all in one pass and without a shuffle."""
    found = []
    for rule in rules:
        if isinstance(rule, NotNull):
            kind, fails = "NOT NULL", F.col(rule.column).isNull()
        else:
            kind, fails = "CHECK", ~_stable(df, rule)
        report = F.struct(
            F.lit(kind).alias("rule_kind"), F.lit(rule.name).alias("rule_name"),
            F.lit(rule.column).alias("column_name"),
            F.lit(f"{kind} failed: {rule.name}").alias("message"),
        )
        found.append(F.when(fails, report))
    return df.select(
        F.lit(table).alias("table_name"), row_key.cast("string").alias("row_key"),
        F.inline(F.array_compact(F.array(*found))),
    )


def first_broken(df: DataFrame, rules: list[NotNull | Check]) -> Column:
    """The kind and name of the first rule that a row breaks by itself, or NULL."""
    ordered = sorted(rules, key=lambda r: (not isinstance(r, NotNull), r.name))
    broken = [
        F.when(F.col(rule.column).isNull(), named("NOT NULL", rule)) if isinstance(rule, NotNull)
        else F.when(~_stable(df, rule), named("CHECK", rule))
        for rule in ordered
    ]
    return F.coalesce(*broken) if broken else F.lit(None).cast("struct<refused_for: string, refused_rule: string>")


def named(kind: str, rule: Rule) -> Column:
    """Why a row is refused."""
    return F.struct(F.lit(kind).alias("refused_for"), F.lit(rule.name).alias("refused_rule"))


def refuse_by_lookup(df: DataFrame, why: str, rule: Unique | ForeignKey, known: DataFrame) -> DataFrame:
    """Fill ``why`` of rows it is still NULL for: a stored row has the key, or no parent has it.

    One row of ``known`` per key; it may be the static side of a stream's join.
    """
    unique = isinstance(rule, Unique)
    own, other = (rule.columns, rule.columns) if unique else ((rule.column,), (rule.parent_column,))
    listed = known.select(*[F.col(c).alias(f"_known_{i}") for i, c in enumerate(other)], F.lit(True).alias("_known"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_known_{i}") for i, c in enumerate(own)])
    asked = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in own])
    found = F.col("_known").isNotNull() if unique else asked & F.col("_known").isNull()
    broken = F.when(found, named("UNIQUE" if unique else "FOREIGN KEY", rule))
    columns = df.columns
    return df.join(listed, same, "left").withColumn(why, F.coalesce(why, broken)).select(columns)


def unique_violations(
    df: DataFrame, table: str, row_key: Column, rule: Unique, sequence: Column,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is taken, by a stored row or an earlier row of the batch.

    ``sequence`` orders the batch; the lowest one keeps the key, and of equal ones
    the lowest row key. Rows alike in all of these are copies: one keeps the key and
    every other is reported. Only keys that occur twice are joined back. The key is
    a struct, inside which NULLs compare as equal.
    """
    parts = [F.lower(c) if rule.ignore_case else F.col(c) for c in rule.columns]
    key = F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]).alias("_key")
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    complete = df.where(known) if rule.nulls_distinct else df
    keyed = complete.select(row_key.alias("_row"), sequence.alias("_seq"), key)
    clashes = (
        keyed.groupBy("_key")
        .agg(F.min(F.struct("_seq", "_row")).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    clashing = join_to_summary(keyed, clashes, "_key", "_n").groupBy("_key", "_seq", "_row", "_first").agg(
        F.count(F.lit(1)).alias("_copies"))
    keeps = F.struct("_seq", "_row") == F.col("_first")
    taken = _copied(clashing, F.when(keeps, F.col("_copies") - 1).otherwise(F.col("_copies"))).select("_row")
    if stored is not None:
        held = (stored.where(known) if rule.nulls_distinct else stored).select(key)
        taken = taken.union(keyed.join(held, "_key", "left_semi").select("_row")).distinct()
    return _broken(taken, table, F.col("_row"), "UNIQUE", rule.name, ",".join(rule.columns))


def _copied(rows: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times, in blocks, so no long list is held."""
    blocks = rows.withColumn("_times", times).where("_times > 0").withColumn(
        "_block", F.explode(F.expr(f"sequence(0, (_times - 1) div {_COPY_BLOCK})")))
    within = F.expr(f"sequence(1, least(_times - _block * {_COPY_BLOCK}, {_COPY_BLOCK}))")
    return blocks.withColumn("_copy", F.explode(within)).drop("_times", "_block", "_copy")


def reference_violations(
    df: DataFrame, table: str, row_key: Column, rule: ForeignKey, parent: DataFrame
) -> DataFrame:
    """Rows pointing at a parent that does not exist."""
    present = df.where(F.col(rule.column).isNotNull())
    orphans = without_match(present, rule.column, parent, rule.parent_column, unique=True)
    return _broken(orphans, table, row_key, "FOREIGN KEY", rule.name, rule.column)


def violations(
    df: DataFrame, table: str, row_key: Column, rules: list[Rule], parents: dict[str, DataFrame],
    sequence: Column | None = None, stored: DataFrame | None = None,
) -> DataFrame:
    """Every broken rule of every row."""
    found = []
    in_row = [r for r in rules if isinstance(r, NotNull | Check)]
    if in_row:
        found.append(row_violations(df, table, row_key, in_row))
    for rule in rules:
        if isinstance(rule, Unique):
            order = row_key if sequence is None else sequence
            found.append(unique_violations(df, table, row_key, rule, order, stored))
        elif isinstance(rule, ForeignKey):
            parent = parents[rule.parent]
            found.append(reference_violations(df, table, row_key, rule, parent))
    return union_all(found)


def precedence() -> Column:
    """1 for the kind reported first."""
    rank = F.array_position(F.array(*[F.lit(k) for k in PRECEDENCE]), F.col("rule_kind"))
    return rank.cast("int")


def first_violation(broken: DataFrame) -> DataFrame:
    """The one rule each row is refused for, and how many it breaks."""
    rest = ["rule_kind", "rule_name", "column_name", "message"]
    first = F.min(F.struct(precedence().alias("rank"), "rule_name", "rule_kind", "column_name",
                           "message")).alias("first")
    return broken.groupBy("table_name", "row_key").agg(first, F.count(F.lit(1)).alias("broken")) \
        .select("table_name", "row_key", *[f"first.{c}" for c in rest], "broken")


def judged(df: DataFrame, row_key: Column, broken: DataFrame) -> DataFrame:
    """Each row with the rule that refuses it, or NULL where it is accepted."""
    reasons = first_violation(broken).select(
        F.col("row_key").alias("_row"), F.col("rule_kind").alias("refused_for"),
        F.col("rule_name").alias("refused_rule"),
    )
    return df.withColumn("_row", row_key.cast("string")).join(reasons, "_row", "left").drop("_row")


def split(df: DataFrame, row_key: Column, broken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and quarantined rows with their reason.

    The judged rows are written once, so the two outputs do not check twice.
    """
    rows = materialize(judged(df, row_key, broken), "judged")
    refused = F.col("refused_for").isNotNull()
    return rows.where(~refused).select(df.columns), rows.where(refused)


def with_messages(broken: DataFrame, messages: DataFrame) -> DataFrame:
    """Replace the raw message by the text of the rule, else of the rule's kind.

    ``messages`` has ``rule_kind, rule_name, user_text``; a NULL name is the
    kind's default.
    """
    named = messages.where(F.col("rule_name").isNotNull()).select(
        "rule_name", F.col("user_text").alias("_named")
    )
    default = messages.where(F.col("rule_name").isNull()).select(
        "rule_kind", F.col("user_text").alias("_default")
    )
    return (
        broken.join(named, "rule_name", "left")
        .join(default, "rule_kind", "left")
        .withColumn("user_text", F.coalesce("_named", "_default", "message"))
        .select(*CONTRACT, "user_text")
    )


def expectation(name: str, expected: Column | int, actual: Column) -> Column:
    """One line of an expectation report, as a struct of numbers."""
    want = F.lit(expected) if isinstance(expected, int) else expected
    want = want.cast("bigint")
    have = actual.cast("bigint")
    return F.struct(
        F.lit(name).alias("check"), want.alias("expected"), have.alias("actual"),
        want.eqNullSafe(have).alias("ok"),
    )
