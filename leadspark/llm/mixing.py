"""Problem 9: sources mixed to target shares of all tokens.

Method: Efraimidis-Spirakis sampling. Every text draws an exponential key, -ln(u) / quality; sorted by it, a source's texts are taken
until their prefix sum reaches the source's token budget, so that better texts come first without being certain. A source whose budget
exceeds its tokens goes through complete epochs first and samples only the rest, and no text is used more than its source's max_repeats.

Prefix sums run over range partitions of (source, key): each task sums its own piece, the pieces' totals (one row per piece and source)
give the offsets. No source is gathered in one task.
"""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, map_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern of this vocabulary's pre-tokeniser.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The piece of (source, key) that one task sums; a piece of rows this small sorts in memory.
PIECE = 200_000


@lru_cache(2)
def _encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("mixing", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def sized(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(text_hash, doc_id, source, tokens, quality) of every distinct text: its smallest doc_id with that one's source, its size in
    tokens, and its quality: the share of different tokens, from 0.05 (one token over and over) to 1. Null and empty texts have no size
    and are left out. The tokenizer's file is read by the driver and sent to the tasks: under 2 MB, or it is refused."""
    with open(tokenizer, "rb") as f:
        ranks = f.read(2_000_001)
    if len(ranks) > 2_000_000:
        raise ValueError("the vocabulary is larger than 2 MB")
    shared = documents.sparkSession.sparkContext.broadcast(ranks)
    docs = documents.where("text is not null and text <> ''").select(F.md5("text").alias("text_hash"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text")

    def run(b):
        ids = _encoder(shared.value).encode_ordinary_batch(b["text"], num_threads=1)
        return {"text_hash": b["text_hash"], "doc_id": b["doc_id"], "source": b["source"], "tokens": [len(i) for i in ids], "quality": [max(0.05, len(set(i)) / max(1, len(i))) for i in ids]}

    each = map_batches(docs, run, "text_hash string, doc_id long, source string, tokens long, quality double")
    return each.groupBy("text_hash").agg(F.min(F.struct("doc_id", "source", "tokens", "quality")).alias("first")).select("text_hash", "first.*")


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 42, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares). mixture: (doc_id, source, tokens, repeats) of every text used; shares: per target source (source, target_share,
    max_repeats, available_tokens, budget, epochs, used_tokens, actual_share).

    total: tokens of the mixture; by default the most at which every source can reach its share under its max_repeats. A source that
    cannot (a total was given, or it has no text) gives what it has, and its actual share says so. Sources not listed, null sources and
    shares of 0 are left out. Ties of keys are broken by the text's hash; repeated documents are one text."""
    wanted = targets.where("target_share > 0").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    texts = cut(sized(documents, tokenizer).join(wanted, "source"))
    there = texts.groupBy("source").agg(F.sum("tokens").alias("available"))
    plan = wanted.join(there, "source", "left").fillna(0, ["available"])
    if total is None:
        most = plan.where("available > 0").agg(F.min(F.col("available") * F.col("max_repeats") / F.col("target_share"))).first()[0]
        total = int(most or 0)
    # complete epochs first, then a part of one
    plan = plan.withColumn("budget", F.least(F.floor(F.lit(float(total)) * F.col("target_share")), F.col("available") * F.col("max_repeats")).cast("long"))
    plan = cut(plan.withColumn("epochs", F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available"))).otherwise(0).cast("long")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available")))
    u = (F.pmod(F.xxhash64("text_hash", F.lit(seed)), F.lit(2**52)) + 0.5) / float(2**52)
    keyed = texts.select("text_hash", "doc_id", "source", "tokens", (-F.log(u) / F.col("quality")).alias("key"))
    parts = max(1, -(-texts.count() // PIECE), texts.sparkSession.sparkContext.defaultParallelism)
    keyed = cut(keyed.repartitionByRange(parts, "source", "key", "text_hash").withColumn("piece", F.spark_partition_id()))
    pieces = keyed.groupBy("source", "piece").agg(F.sum("tokens").alias("sum"))
    before = pieces.withColumn("before", F.coalesce(F.sum("sum").over(W.partitionBy("source").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("sum")
    inside = F.sum("tokens").over(W.partitionBy("source", "piece").orderBy("key", "text_hash").rowsBetween(W.unboundedPreceding, 0))
    summed = keyed.withColumn("inside", inside).join(before, ["source", "piece"]).withColumn("prefix", F.col("before") + F.col("inside"))
    chosen = summed.join(plan.select("source", "epochs", "rest"), "source").withColumn("repeats", F.col("epochs") + (F.col("prefix") <= F.col("rest")).cast("long")).where("repeats > 0").select("doc_id", "source", "tokens", "repeats")
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("used_tokens"))
    shares = plan.join(used, "source", "left").fillna(0, ["used_tokens"])
    everything = F.sum("used_tokens").over(W.partitionBy())  # one row per target source
    shares = shares.withColumn("actual_share", F.round(F.col("used_tokens") / F.greatest(everything, F.lit(1)), 6)).select("source", "target_share", "max_repeats", F.col("available").alias("available_tokens"), "budget", "epochs", "used_tokens", "actual_share")
    return chosen, shares
