"""Connected components (G1, G5) by min-label propagation with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from granary.session import forget, written

#: Edges that one task merges, at most: some megabytes.
FEW_EDGES = 200_000


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict = {}

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.types[0]
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(up.setdefault(u, u)), top(up.setdefault(v, v))
            up[max(a, b)] = min(a, b)
    if up:
        yield pa.RecordBatch.from_arrays([pa.array(list(up), kind), pa.array([top(x) for x in up], kind)], ["node", "component"])


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 60, one_task: int = 0) -> DataFrame:
    """Label every node of ``edges`` with the smallest node of its component: columns ``node``, ``component``.

    A node may be of any orderable type; edges may repeat, loop or hold nulls (these are ignored).  Each round takes the
    smallest label among the neighbours (a partial aggregate, so a hub costs no task more than its rows) and then jumps
    to the label of that label, so chains halve.  Labels are written to the shared folder after each round.  Up to
    ``one_task`` edges, counted first, one task merges them in a single round instead.
    """
    known = edges.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    way = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    # one pass makes both ways, so the edges are made once
    ways = written(known.select(F.explode(F.array(way(left, right), way(right, left))).alias("w")).select("w.u", "w.v").distinct(), "edges")
    kind = ways.schema["u"].dataType
    if one_task and isinstance(kind, (StringType, IntegralType)) and ways.count() <= 2 * one_task:
        found = ways.where("u <= v").coalesce(1).mapInArrow(_in_one_task, f"node {kind.simpleString()}, component {kind.simpleString()}")
        labels = written(found, "labels")
        forget(ways)
        return labels
    labels = written(
        ways.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")),
        "labels",
    )
    for _ in range(max_rounds):
        near = (
            ways.join(labels, ways.v == labels.node)
            .groupBy(F.col("u").alias("near_node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, labels.node == near.near_node).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("low")
        )
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("further"))
        jumped = written(
            lowered.join(jump, "low").select("node", "was", F.least("low", "further").alias("component")), "labels"
        )
        changed = jumped.where("component <> was").limit(1).count()
        forget(labels)
        labels = jumped.select("node", "component")
        if not changed:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    forget(ways)
    return labels
