"""Updates, deletes and upserts as new versions of a table.

Each function takes the current rows and a change and returns the rows after it;
writing them as the next version is up to the caller. A predicate that is NULL
for a row does not touch that row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import keys, without_match
from ledgerlark.operators.ranking import with_new_ids


def update_rows(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the predicate holds."""
    return df.withColumns({
        name: F.when(predicate, value).otherwise(F.col(name)) for name, value in values.items()
    })


def delete_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop the rows for which the predicate is TRUE, keep FALSE and UNKNOWN."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_cascade(
    parents: DataFrame, key: str, predicate: Column, children: DataFrame, child_key: str
) -> tuple[DataFrame, DataFrame]:
    """Delete parents together with their children."""
    gone = parents.where(predicate)
    kept = without_match(children, child_key, gone, key, unique=True)
    return delete_rows(parents, predicate), kept


def delete_verdicts(
    parents: DataFrame, key: str, predicate: Column, children: DataFrame, child_key: str
) -> DataFrame:
    """Victims of a delete with the number of children that hold them back."""
    held = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias("children"))
    return (
        parents.where(predicate)
        .select(key)
        .join(held, key, "left")
        .select(
            key, F.coalesce("children", F.lit(0)).alias("children"),
            F.col("children").isNotNull().alias("refused"),
        )
    )


def restrict_and_no_action(verdicts: DataFrame, key: str, inserted_later: DataFrame) -> DataFrame:
    """Compare the two rules for a batch that deletes parents and re-inserts some.

    RESTRICT looks at the moment of the delete, NO ACTION after the whole batch.
    """
    back = keys(inserted_later, key).withColumn("back", F.lit(True))
    return verdicts.join(back, key, "left").select(
        key, "children",
        F.coalesce("back", F.lit(False)).alias("inserted_again"),
        (~F.col("refused")).alias("restrict_allows"),
        (~F.col("refused") | F.col("back").isNotNull()).alias("no_action_allows"),
    )


def delete_set_null(
    parents: DataFrame, key: str, predicate: Column, children: DataFrame, child_key: str
) -> DataFrame:
    """Children after their deleted parents' keys became NULL."""
    gone = parents.where(predicate).select(
        F.col(key).alias(child_key), F.lit(True).alias("_gone")
    )
    return (
        children.join(gone, child_key, "left")
        .withColumn(child_key, F.when(F.col("_gone").isNull(), F.col(child_key)))
        .select(children.columns)
    )


def upsert_ignore(current: DataFrame, batch: DataFrame, key: str, sequence: str) -> DataFrame:
    """ON CONFLICT DO NOTHING: a known key stays, a new one enters with its first row.

    ``key`` is the key of the table, unique and not NULL.
    """
    first = batch.groupBy(key).agg(F.min_by(F.struct(*current.columns), sequence).alias("row"))
    fresh = first.join(current.select(key), key, "left_anti").select("row.*")
    return current.unionByName(fresh)


def upsert_update(
    current: DataFrame, batch: DataFrame, key: str, columns: list[str], sequence: str
) -> DataFrame:
    """ON CONFLICT DO UPDATE of ``columns``; ``key`` is unique and not NULL.

    Rows of the batch apply in ``sequence`` order: a key new to the table enters
    with its first row, and the last row of the batch decides ``columns``.
    """
    rest = [c for c in current.columns if c != key and c not in columns]
    change = batch.groupBy(key).agg(
        F.min_by(F.struct(F.lit(True).alias("_seen"), *rest), sequence).alias("first"),
        F.max_by(F.struct(*columns), sequence).alias("last"),
    )
    known = current.withColumn("_known", F.lit(True))
    both = known.join(change, key, "full")
    changed = F.col("last").isNotNull()
    return both.select(
        key,
        *[F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"first.{c}")).alias(c) for c in rest],
        *[F.when(changed, F.col(f"last.{c}")).otherwise(F.col(c)).alias(c) for c in columns],
    ).select(current.columns)


def upsert_natural(
    current: DataFrame, batch: DataFrame, id_column: str, natural: list[str], columns: list[str], sequence: str,
    order: list[str],
) -> DataFrame:
    """Upsert on a natural key; rows new to the table get ids after the highest one.

    The batch has no ids. Rows in ``sequence`` order conflict on ``natural`` with the
    table or with each other: the first brings a new row in, the last decides
    ``columns`` (none: ON CONFLICT DO NOTHING). A key with a NULL in it conflicts with
    nothing, so such rows all enter. ``order`` makes the new ids follow the batch; it
    must end in something unique.
    """
    complete = reduce(and_, [F.col(c).isNotNull() for c in natural])
    rest = [c for c in current.columns if c != id_column]
    keyed, loose = batch.where(complete), batch.where(~complete)
    change = keyed.groupBy(*natural).agg(
        F.min_by(F.struct(*rest, *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(order)]), sequence).alias("first"),
        F.max_by(F.struct(*columns, F.lit(True).alias("_seen")), sequence).alias("last"),
    )
    last = change.select(*natural, "last")
    held = current.join(last, natural, "left")
    kept = held.select(*[
        F.when(F.col("last").isNotNull(), F.col(f"last.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in current.columns
    ])
    fresh = change.join(current.where(complete).select(*natural), natural, "left_anti").select(*[
        F.col(f"last.{c}").alias(c) if c in columns else F.col(f"first.{c}").alias(c) for c in rest
    ], *[f"first._by_{i}" for i in range(len(order))])
    entering = fresh.unionByName(loose.select(*rest, *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(order)]))
    highest = F.coalesce(current.agg(F.max(id_column)).scalar(), F.lit(0))
    numbered = with_new_ids(entering, [F.asc(f"_by_{i}") for i in range(len(order))], highest, id_column)
    return kept.unionByName(numbered.select(
        F.col(id_column).cast(current.schema[id_column].dataType).alias(id_column), *rest))


def atomic_orders(
    headers: DataFrame, key: str, lines: DataFrame, line_key: str, line_ok: Column
) -> DataFrame:
    """Verdict per order: all its lines are good, or the whole order is refused.

    An order without lines is refused as well.
    """
    judged = lines.groupBy(F.col(line_key).alias(key)).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(~F.coalesce(line_ok, F.lit(False))).alias("bad_lines"),
    )
    bad, count = F.col("bad_lines"), F.col("line_count")
    reason = F.when(count.isNull(), "no lines").when(bad > 0, "bad line").otherwise("accepted")
    return headers.select(key).join(judged, key, "left").select(
        key, F.coalesce(count, F.lit(0)).alias("line_count"),
        F.coalesce(bad, F.lit(0)).alias("bad_lines"), reason.alias("verdict"),
    )


def anonymise(df: DataFrame, predicate: Column, columns: list[str]) -> DataFrame:
    """Soft delete: mark the rows and replace identifying text by its digest."""
    hidden = {c: F.sha2(F.col(c), 256) for c in columns}
    marked = df.withColumn("deleted", F.coalesce(predicate, F.lit(False)))
    return update_rows(marked, F.col("deleted"), hidden)


def with_defaults(batch: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill the columns an INSERT left out; an explicit NULL is not replaced."""
    missing = {name: value for name, value in defaults.items() if name not in batch.columns}
    return batch.withColumns(missing)
