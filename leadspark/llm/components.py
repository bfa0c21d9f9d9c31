"""Problem 5: pairwise links consolidated into groups.

Method: union-find inside the partitions of the edges, which keep only their spanning forests; the forests are merged hierarchically
through partitions of a bounded number of edges until the global components remain.

No task ever sees more than EDGES edges, however large one component or one key is:
* a key held by many rows (a domain, a phone) gives, in each batch of rows, one representative, and then a star over the batches'
  representatives; rows of one key are never gathered;
* a forest that fits one partition is finished there; a larger one goes on in rounds, in each of which every vertex's edges meet in
  one partition (a vertex of very many edges is first thinned within the partitions of the edges).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import pyarrow as pa

from .common import cut

#: The most edges that one task merges.
EDGES = 1_000_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, the smallest vertex of each one's component). Parents are hooked onto smaller ones and paths halved, for all edges at
    once."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(ids))
    u, v = at[: len(a)], at[len(a) :]
    while True:
        x, y = parent[u], parent[v]
        open_ = x != y
        if not open_.any():
            return ids, ids[parent]
        u, v, x, y = u[open_], v[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spanning forest of the edges as stars: (smallest vertex, other vertex)."""
    if not len(a):
        return a, b
    ids, root = union_find(a, b)
    keep = ids != root
    return root[keep], ids[keep]


_EDGE = "a long, b long"


def _merge(edges: DataFrame) -> DataFrame:
    """Each partition of edges replaced by its spanning forest. Beyond EDGES edges a partition is thinned piece by piece."""

    def run(batches):
        a = b = np.empty(0, np.int64)
        for x in batches:
            a = np.concatenate([a, x.column(0).to_numpy(zero_copy_only=False)])
            b = np.concatenate([b, x.column(1).to_numpy(zero_copy_only=False)])
            if len(a) >= EDGES:
                thin = _forest(a, b)
                if len(thin[0]) > EDGES // 2:  # few of them were superfluous here; the next round has others side by side
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, thin)), names=["a", "b"])
                    thin = (np.empty(0, np.int64),) * 2
                a, b = thin
        if len(a):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _forest(a, b))), names=["a", "b"])

    return edges.mapInArrow(run, _EDGE)


def key_edges(df: DataFrame, id: str, keys: list[str]) -> DataFrame:
    """Edges that connect all rows with an equal, non-null key of the same kind (any hashable text), without gathering a key's rows.

    In each batch of rows the first row with a key stands for the others: the batch yields its own spanning forest and one
    representative per key, and the representatives of a key form a star around the least."""
    part = df.select(F.col(id).cast("long").alias("id"), *[F.col(k).cast("string").alias(f"k{n}") for n, k in enumerate(keys)])

    def run(batches):
        for x in batches:
            ids = x.column(0).to_pylist()
            a, b, key, least = [], [], [], {}
            for n in range(len(keys)):
                for i, k in zip(ids, x.column(n + 1).to_pylist()):
                    if k is not None:
                        at = (n, k)
                        j = least.get(at)
                        if j is None:
                            least[at] = i
                        elif i != j:
                            a.append(j)
                            b.append(i)
            fa, fb = _forest(np.array(a, np.int64), np.array(b, np.int64))
            key = [f"{n}:{k}" for n, k in least]
            yield pa.RecordBatch.from_arrays([pa.array([None] * len(fa) + key, pa.string()), pa.array(fa.tolist() + [None] * len(key), pa.int64()), pa.array(fb.tolist() + list(least.values()), pa.int64())], names=["k", "a", "b"])

    local = cut(part.mapInArrow(run, "k string, a long, b long"))
    stood = local.where("k is not null").select("k", "b")
    hubs = stood.groupBy("k").agg(F.min("b").alias("a"), F.max("b").alias("most")).where("a < most").select("k", "a")
    return local.where("k is null").select("a", "b").union(stood.join(hubs, "k").where("a <> b").select("a", "b"))


def components(edges: DataFrame, a: str = "a", b: str = "b", edges_per_task: int = EDGES) -> DataFrame:
    """(id, group_id) of every vertex with an edge to another; group_id is the smallest id of its component.

    Null ends and edges of a vertex with itself are ignored, repeated edges and either order change nothing, no edge gives no row."""
    forest = cut(_merge(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b")))
    n, rounds = forest.count(), 0
    while n > edges_per_task:
        rounds += 1
        # both copies of an edge, so that all edges of a vertex meet; the forest of each partition is one of the whole again
        twice = forest.union(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parts = max(2, -(-2 * n // edges_per_task))
        nxt = cut(_merge(twice.repartition(parts, "a")).distinct())
        # done when nothing but stars is left: no centre is a leaf, no leaf has two centres
        leaf = nxt.groupBy(F.col("b").alias("leaf")).agg(F.count("*").alias("n"))
        bad = leaf.where("n > 1").limit(1).count() or nxt.join(leaf, F.col("a") == F.col("leaf"), "left_semi").limit(1).count()
        forest, n = nxt, nxt.count()
        if not bad:
            break
        if rounds > 60:
            raise RuntimeError("the components did not settle")
    else:
        if n:
            # smaller and smaller numbers of bounded partitions, down to one
            parts = max(1, forest.rdd.getNumPartitions())
            while parts > 1:
                parts = parts // 8 if n > edges_per_task // 8 else 1
                forest = _merge(forest.coalesce(max(1, parts)) if parts > 1 else forest.repartition(1))
            forest = forest if rounds or forest.rdd.getNumPartitions() == 1 else _merge(forest.repartition(1))
    stars = forest.select(F.col("b").alias("id"), F.col("a").alias("group_id"))
    return stars.union(stars.select(F.col("group_id").alias("id"), "group_id").distinct())
