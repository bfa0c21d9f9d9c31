"""Connected components: spanning forests of the partitions, merged in one task if they fit it, else by alternating star contraction, in which
rows of a vertex are never gathered, only their minimum is."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() in the folder of spark.checkpoint.dir, which executors share; on one machine without it, a temporary one."""
    spark: SparkSession = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not at and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="leadspark-"))
    return df.checkpoint(eager=True)


#: The most edges that one task merges.
EDGES = 4_000_000


def stars(v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) of all other vertices than those smallest ones. Union-find, all edges at once."""
    ids, at = np.unique(np.concatenate([v, u]), return_inverse=True)
    root, x, y = np.arange(len(ids)), at[: len(v)], at[len(v) :]
    while len(x):
        p, q = root[x], root[y]
        apart = p != q
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]
    leaf = ids[root] != ids
    return ids[leaf], ids[root][leaf]


def forest(edges: DataFrame) -> DataFrame:
    """Edges (v, u) that connect what the edges (v, u) of each partition do, as stars. Beyond EDGES of them a partition is thinned piece by
    piece."""

    def run(batches):
        v = u = np.empty(0, np.int64)
        have, n = [], 0
        for b in batches:
            have.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            n += b.num_rows
            if n > EDGES:
                v, u = stars(*map(np.concatenate, zip(*have)))
                if len(v) > EDGES // 2:  # few were superfluous
                    yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(u)], names=["v", "u"])
                    v = u = np.empty(0, np.int64)
                have, n = [(v, u)], len(v)
        if n:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, stars(*map(np.concatenate, zip(*have))))), names=["v", "u"])

    return edges.mapInArrow(run, "v long, u long")


def components(edges: DataFrame, most_rounds: int = 60, most: int = EDGES) -> DataFrame:
    """(id, component) for every vertex of the edges (a, b); component is the smallest id. Loops and nulls are ignored. Up to `most` edges of
    the partitions' forests are merged in one task."""
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    now = cut(forest(e.select(F.col("a").alias("v"), F.col("b").alias("u"))))
    if now.count() <= most:
        now = cut(forest(now.repartition(1)))
    else:
        now = _contracted(now.distinct(), most_rounds)
    return now.select(F.col("v").alias("id"), F.col("u").alias("component")).union(now.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())


def _contracted(now: DataFrame, most_rounds: int) -> DataFrame:
    """(v, smallest vertex of its component) for the edges (v, u), u less than v."""
    now = cut(now)
    for _ in range(most_rounds):
        # large star: the larger neighbours of every vertex are tied to its least neighbour
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # small star: the smaller neighbours of every vertex, and itself, are tied to the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").union(low.select("v", F.col("m").alias("u"))).distinct()
        nxt = cut(small)
        changed = nxt.exceptAll(now).limit(1).count() or now.exceptAll(nxt).limit(1).count()
        now = nxt
        if not changed:
            return now
    raise RuntimeError("the components did not settle")
