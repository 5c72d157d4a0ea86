"""What can be reached over references: rounds over a frontier, until nothing is added.

Every round joins only what the round before has added, and writes what it adds, so plans do
not grow into each other, a lost executor costs a round at most, and cycles end by
themselves. The driver sees one count per round and table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import without_match
from ledgerlark.operators.sets import union_all
from ledgerlark.sources.scratch import materialize_counted
from ledgerlark.sources.tables import Reference


def reached(edges: DataFrame, source: str, target: str, start: DataFrame, node: str, depth: int | None = None) -> DataFrame:
    """(node, step) of every node that can be reached, with the fewest steps to it.

    The start is at step 0; ``depth`` bounds the steps. NULLs lead nowhere.
    """
    links = edges.select(F.col(source).alias("_from"), F.col(target).alias("_to")).where("_from IS NOT NULL AND _to IS NOT NULL")
    first = start.select(F.col(node).alias("node")).where("node IS NOT NULL").distinct()
    found, count = materialize_counted(first.withColumn("step", F.lit(0)), "reached")
    levels, step = [found], 0
    while count and (depth is None or step < depth):
        step += 1
        ahead = links.join(levels[-1].select(F.col("node").alias("_from")), "_from").select(F.col("_to").alias("node")).distinct()
        fresh = ahead.join(union_all(levels).select("node"), "node", "left_anti")
        found, count = materialize_counted(fresh.withColumn("step", F.lit(step)), "reached")
        if count:
            levels.append(found)
    return union_all(levels)


@dataclass(frozen=True)
class Deletion:
    """What a delete does to every table.

    ``gone`` are the keys of the deleted rows of tables that others refer to, ``tables`` the
    tables after it, and ``held`` the references that forbid it, with their number of rows.
    """

    gone: dict[str, DataFrame]
    tables: dict[str, DataFrame]
    held: DataFrame


def delete_through(tables: dict[str, DataFrame], references: list[Reference], table: str, victims: DataFrame) -> Deletion:
    """Delete the rows of ``table`` whose key is among ``victims`` (one column), and all that
    must follow.

    CASCADE carries the deletion on, through any number of tables and around cycles. SET
    NULL empties the column of rows that stay. RESTRICT forbids deleting a row that any row
    refers to, even one that goes as well; NO ACTION looks at the rows that are left in the
    end. A reference that is NULL refers to nothing.
    """
    keys = {r.parent: r.parent_column for r in references}
    key = keys.setdefault(table, victims.columns[0])
    named = victims.select(F.col(victims.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    first, _ = materialize_counted(tables[table].select(key).join(named, key, "left_semi").distinct(), f"gone-{table}")
    parts, frontier = {table: [first]}, {table: first}
    cascades = [r for r in references if r.on_delete == "CASCADE"]
    while frontier:
        hit: dict[str, list[DataFrame]] = {}
        for r in cascades:
            if r.parent in frontier and r.child in keys:
                lost = frontier[r.parent].select(F.col(keys[r.parent]).alias(r.column))
                own = tables[r.child].join(lost, r.column, "left_semi").select(keys[r.child])
                hit.setdefault(r.child, []).append(own)
        frontier = {}
        for name, found in hit.items():
            fresh = union_all(found).where(F.col(keys[name]).isNotNull()).distinct()
            if name in parts:
                fresh = fresh.join(union_all(parts[name]), keys[name], "left_anti")
            rows, count = materialize_counted(fresh, f"gone-{name}")
            if count:
                parts.setdefault(name, []).append(rows)
                frontier[name] = rows
    gone = {name: union_all(rows) for name, rows in parts.items()}
    return _settled(tables, references, table, keys, gone)


def _settled(tables, references, table, keys, gone) -> Deletion:
    after, held = {}, []
    for name, rows in tables.items():
        left = without_match(rows, keys[name], gone[name], keys[name], unique=True) if name in gone else rows
        lost = [(r, gone[r.parent]) for r in references if r.child == name and r.parent in gone]
        for r, parents in lost:
            if r.on_delete == "CASCADE":  # rows without a key of their own go by their reference
                left = without_match(left, r.column, parents, keys[r.parent], unique=True)
        for r, parents in lost:
            named = parents.select(F.col(keys[r.parent]).alias(r.column), F.lit(True).alias("_lost"))
            if r.on_delete == "SET NULL":
                emptied = F.when(F.col("_lost").isNull(), F.col(r.column))
                left = left.join(named, r.column, "left").withColumn(r.column, emptied).select(rows.columns)
            elif r.on_delete != "CASCADE":
                base = rows if r.on_delete == "RESTRICT" else left
                held.append(base.join(named, r.column, "left_semi").agg(
                    F.lit(r.child).alias("child"), F.lit(r.column).alias("column_name"), F.lit(r.on_delete).alias("on_delete"),
                    F.count(F.lit(1)).alias("held_rows")))
        after[name] = left
    none = tables[table].sparkSession.createDataFrame([], "child string, column_name string, on_delete string, held_rows long")
    return Deletion(gone, after, union_all([none, *held]).where("held_rows > 0"))
