"""Exact radius joins of strings under the edit distance, by metric-space partitioning.

Strings are assigned to their nearest pivot. Since the edit distance is a metric, a string y within r of a string x whose nearest pivot
is p has d(y, p) <= d(y, nearest pivot of y) + 2r: copying boundary strings that far makes every pair meet in the cell of either
string. Cells that are still large are partitioned again, under new pivots.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, edit_distance, map_batches, map_partitions

#: A cell of more strings than this is partitioned under about so many pivots; after so many levels cells stay as they are.
CELL, PIVOTS, LEVELS = 256, 24, 4


def assign(key: str, pivots: list[str], radius: int) -> list[tuple[int, bool]]:
    """(pivot, whether it is the nearest) for the cells that key must be in."""
    d = [edit_distance(key, p, 64) for p in pivots]
    near = min(range(len(d)), key=lambda k: (d[k], k))
    return [(k, k == near) for k, x in enumerate(d) if k == near or x <= d[near] + 2 * radius]


def cells(keys: DataFrame, radius: int, cell: int = CELL, pivots: int = PIVOTS, levels: int = LEVELS) -> DataFrame:
    """(block, cell, key, owner) of distinct (block, key): every two keys of a block within the radius meet in the cell that either of
    them owns. A key owns one cell and visits others."""
    now = keys.select("block", F.lit("").alias("cell"), "key", F.lit(True).alias("owner"))
    done: DataFrame | None = None
    for level in range(levels):
        sizes = now.groupBy("block", "cell").agg(F.count("*").alias("n")).where(F.col("n") > cell)
        if level == 0 and not sizes.limit(1).count():
            return now
        large = now.join(sizes, ["block", "cell"])
        # pivots: a fraction of the keys chosen by their hash, so that no cell is sorted or gathered
        chosen = large.where(F.pmod(F.xxhash64("key", F.lit(level)), F.greatest(F.lit(1), F.floor(F.col("n") / pivots))) == 0).groupBy("block", "cell").agg(F.slice(F.array_sort(F.collect_set("key")), 1, 4 * pivots).alias("pivots"))
        split = cut(large.join(chosen, ["block", "cell"]).select("block", "cell", "key", "owner", "pivots"))
        small = now.join(chosen.select("block", "cell"), ["block", "cell"], "left_anti")
        done = small if done is None else done.union(small)
        if not split.limit(1).count():
            return done

        def run(b):
            out = {"block": [], "cell": [], "key": [], "owner": []}
            for block, c, key, owner, ps in zip(b["block"], b["cell"], b["key"], b["owner"], b["pivots"]):
                for k, own in assign(key, ps, radius):
                    out["block"].append(block)
                    out["cell"].append(f"{c}.{k}")
                    out["key"].append(key)
                    out["owner"].append(owner and own)
            return out

        now = cut(map_batches(split, run, "block string, cell string, key string, owner boolean"))
    return done.union(now)


def within(keys: list[tuple[str, bool]], radius: int) -> list[tuple[str, str, int]]:
    """(a, b, distance) of all pairs of one cell, a < b, that are within the radius and of which a owns the cell."""
    out, by_length = [], defaultdict(list)
    for k, owner in keys:
        by_length[len(k)].append((k, owner))
    for n, here in by_length.items():
        for m in range(n, n + radius + 1):
            for x, (a, own_a) in enumerate(here):
                for b, own_b in by_length[m][x + 1 :] if m == n else by_length.get(m, ()):
                    if (own_a if a < b else own_b) and a != b:
                        d = edit_distance(a, b, radius)
                        if d <= radius:
                            out.append((min(a, b), max(a, b), d))
    return out


def radius_join(df: DataFrame, block: str, key: str, radius: int, **limits: int) -> DataFrame:
    """(block, a, b, distance), a < b: all pairs of different keys of one block within the radius.

    Null keys or blocks pair with nothing; repeated rows count once; an empty table gives no row."""
    keys = df.select(F.col(block).cast("string").alias("block"), F.col(key).alias("key")).where("block is not null and key is not null").distinct()
    parts = cells(keys, radius, **limits).repartition("block", "cell").sortWithinPartitions("block", "cell")

    def run(batches):
        at, have = None, []
        for b in batches:
            out = []
            for bl, c, k, o in zip(b["block"], b["cell"], b["key"], b["owner"]):
                if (bl, c) != at:
                    if at is not None:
                        out += [(at[0], *p) for p in within(have, radius)]
                    at, have = (bl, c), []
                have.append((k, o))
            yield dict(zip(("block", "a", "b", "distance"), map(list, zip(*out)) if out else ([], [], [], [])))
        out = [(at[0], *p) for p in within(have, radius)] if at is not None else []
        yield dict(zip(("block", "a", "b", "distance"), map(list, zip(*out)) if out else ([], [], [], [])))

    return map_partitions(parts, run, "block string, a string, b string, distance int").distinct()
