"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.session import BROADCAST_BYTES, broadcast_if_small, discard, materialise

MAX_ROUNDS = 64
#: Edges that one task contracts at once.
CONTRACTED = 200_000
#: Bytes of a row of two ids in a broadcast table.
_ROW = 48


def spanning_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (vertex, least vertex) with the same components as the edges u - v."""
    if not len(u):
        return u, v
    names, local = np.unique(np.stack([u, v], 1), return_inverse=True)
    local = local.reshape(-1, 2)
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # an edge counts once, whatever its direction
    low, high = local.min(1), local.max(1)
    for key in np.unique(low * len(names) + high).tolist():
        a, b = root(key // len(names)), root(key % len(names))
        parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(names))])
    moved = roots != np.arange(len(names))
    return names[moved], names[roots[moved]]


def _contract(batches):
    """Edges of a task -> star edges with the same components, a bounded number at a time."""
    held, size = [], 0

    def flush():
        u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in spanning_edges(u, v)], ["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CONTRACTED:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _star(edges: DataFrame, n: int, smaller_only: bool) -> DataFrame:
    """One star step: neighbours of u are linked to the least vertex around u.

    The minimum comes from a groupBy with partial aggregation and is joined back, so that no
    vertex's neighbourhood is ever gathered in one task: at most 2 n minima are broadcast if they
    are small, else they are a table of their own, so that Spark can split the rows of a vertex
    with very many neighbours.
    """
    if smaller_only:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
    else:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if 2 * n * _ROW > BROADCAST_BYTES:
        least, _ = materialise(least, "least")
    joined = around.join(broadcast_if_small(least, 2 * n, _ROW), "u")
    if smaller_only:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and sum of hashes of distinct edges: equal for equal sets of edges."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def connected_components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(u, v) edges of comparable ids -> (node, component), component = least id reachable.

    Nulls: an edge with a null end is dropped. Self loops keep their vertex as a component of its
    own. Repeated edges do not matter. An empty edge table gives an empty result. Every round ends
    in a table in the shared folder, so a lost executor costs one round at most. Edges with long
    ids are first contracted within their tasks, which saves rounds.
    """
    spark = edges.sparkSession
    # tasks find the same edges again and again; their number must not grow with that of tasks
    whole = edges.select("u", "v").where("u is not null and v is not null").distinct()
    whole, source = materialise(whole, "edges")
    current = whole.where("u <> v")
    if [kind for _, kind in whole.dtypes] == ["bigint", "bigint"]:
        current = current.mapInArrow(_contract, "u long, v long")
    current, path = materialise(current.distinct(), "star")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        step, new_path = materialise(_star(_star(current, state[0], False), state[0], True), "star")
        discard(spark, path)
        before, state, current, path = state, _state(step), step, new_path
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    nodes = whole.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    labelled = nodes.join(broadcast_if_small(found, state[0], _ROW), "node", "left")
    out, _ = materialise(labelled.select("node", F.coalesce("component", "node").alias("component")), "components")
    discard(spark, source, path)
    return out
