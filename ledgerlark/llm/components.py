"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import materialize, materialize_counted

# Steps a node goes down in one round, as a power of two.
JUMPS = 2

# Edges that a task makes a forest of at once.
FOREST = 1 << 19


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b), comp being one node of its component.

    Every round bounded stretches of the edges become forests, then each node points to
    the node next to it with the least hash, if that is less than its own, and goes down the
    pointers; the edges are redrawn between where their ends have gone, until none is left.
    Hashes differ by round, so the number of rounds grows with the logarithm of the size of a
    component, whatever its shape.
    """
    return _joined(*materialize_counted(_drawn(edges, "a", "b"), "edges"))


def _joined(edges: DataFrame, left: int) -> DataFrame:
    """The same of drawn and written edges, of which there are ``left``."""
    comps, turn = None, 0
    while left:
        turn += 1

        def ranked(node: str) -> Column:
            return F.struct(F.xxhash64(node, F.lit(turn)).alias("rank"), F.col(node).alias("node"))

        both = edges.select(
            "a", "b", ranked("a")["rank"].alias("rank_a"), ranked("b")["rank"].alias("rank_b")
        ).mapInArrow(_forests, "a long, b long")
        near = both.groupBy("a").agg(F.min(ranked("b")).alias("near"))
        step = materialize(near.select(F.col("a").alias("node"), F.least("near", ranked("a"))["node"].alias("to")), "steps")
        for _ in range(JUMPS):
            step = step.join(step.select(F.col("node").alias("to"), F.col("to").alias("far")), "to").select(
                "node", F.col("far").alias("to"))
        step = materialize(step, "steps")
        ends = {end: step.select(F.col("node").alias(end), F.col("to").alias(f"to_{end}")) for end in "ab"}
        edges, left = materialize_counted(_drawn(edges.join(ends["a"], "a").join(ends["b"], "b"), "to_a", "to_b"), "edges")
        if comps is None:
            comps = step.withColumnRenamed("to", "comp")
        else:
            comps = materialize(_moved(comps, step.withColumnRenamed("node", "comp")), "comps")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")) if comps is None else comps


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) between every node of some edges and the node of least rank they join it to, both ways."""

    def forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in range(4)]
        nodes, roots = roots_of(*columns)
        nodes, roots = nodes[nodes != roots], roots[nodes != roots]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([nodes, roots])), pa.array(np.concatenate([roots, nodes]))], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= FOREST:
            yield forest(held)
            held, rows = [], 0
    if rows:
        yield forest(held)


def roots_of(a: np.ndarray, b: np.ndarray, rank_a: np.ndarray, rank_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and of each the node of least rank in its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    rank = np.empty(len(nodes), np.int64)
    rank[place] = np.concatenate([rank_a, rank_b])
    by_rank = np.argsort(rank, kind="stable")
    nodes = nodes[by_rank]
    number = np.empty(len(nodes), np.int64)
    number[by_rank] = np.arange(len(nodes))
    one, two = number[place[:len(a)]], number[place[len(a):]]
    up = np.arange(len(nodes))
    while len(one):
        np.minimum.at(up, np.maximum(one, two), np.minimum(one, two))
        while (up[up] != up).any():
            up = up[up]
        one, two = up[one], up[two]
        one, two = one[one != two], two[one != two]
    return nodes, nodes[up]


def merged(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` after further ``edges``; only the components that these touch are worked on."""
    labels = comps.select("node", "comp")
    for end in "ab":
        edges = edges.join(labels.select(F.col("node").alias(end), F.col("comp").alias(f"to_{end}")), end, "left")
        edges = edges.withColumn(f"to_{end}", F.coalesce(f"to_{end}", end))
    drawn, left = materialize_counted(_drawn(edges, "to_a", "to_b"), "edges")
    if not left:
        return comps
    step = _joined(drawn, left).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    fresh = step.select(F.col("comp").alias("node"), F.col("to").alias("comp")).join(labels, "node", "left_anti")
    return materialize(_moved(labels, step).unionByName(fresh), "comps")


def _drawn(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _moved(comps: DataFrame, step: DataFrame) -> DataFrame:
    return comps.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
