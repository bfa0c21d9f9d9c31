"""Problem 7: the best representative of each group of duplicates, field by field.

Method: a latent two-sided quality model. Each distinct value of a field in a group is a statement that is true or false; a source
that has the field in the group claims it or does not. Expectation-maximisation infers every source's sensitivity (true values that it
claims) and specificity (false values that it does not claim), and each value's probability of being true. Fields may keep all values
judged true (multi-valued: a firm may well have two phones).

Where a single value must be kept, a rule decides among the usable members: the highest trust, then the latest, then the smallest id.
That rule is fixed by TESTDATA.md and leaves the model nothing to decide; the model's probability stands beside each kept value.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, missing, usable_domain, usable_phone
from .encoding import find_damage

FIELDS = ("address", "business_name", "decision_maker_name", "phone_e164", "website_domain")
DAMAGED = ("business_name", "address")
#: Sources are few (a name per file); more than this are not sent to the tasks and the model refuses.
MOST_SOURCES = 100_000
ROUNDS = 8


def usable(field: str) -> Column:
    """Null unless the field's value is one: not missing. Damage is looked up separately."""
    if field == "phone_e164":
        return F.when(usable_phone(field).isNotNull(), F.col(field))
    if field == "website_domain":
        return F.when(usable_domain(field).isNotNull(), F.col(field))
    return F.when(~missing(field), F.col(field))


def candidates(df: DataFrame, trust: DataFrame, group: str = "duplicate_group_id") -> DataFrame:
    """(group_id, field_name, id, value, source, trust, at) of every usable value of grouped rows; sources not listed have trust 0."""
    grouped = df.where(F.col(group).isNotNull())
    damage = find_damage(df, "source_row_id", list(DAMAGED)).select(F.col("source_row_id").alias("id"), "field_name")
    long = grouped.select(
        F.col(group).alias("group_id"),
        F.col("source_row_id").alias("id"),
        F.col("source_file").alias("source"),
        F.col("enriched_at").alias("at"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), usable(f).alias("value")) for f in FIELDS])).alias("v"),
    ).select("group_id", "id", "source", "at", "v.field_name", "v.value")
    long = long.where("value is not null").join(damage, ["id", "field_name"], "left_anti")
    levels = trust.groupBy(F.col("source_file").alias("source")).agg(F.max("trust_level").alias("trust"))
    return long.join(levels, "source", "left").withColumn("trust", F.coalesce("trust", F.lit(0)))


def kept(values: DataFrame) -> DataFrame:
    """(group_id, field_name, id, value): of each group and field the member whose value is kept.

    The highest trust, then the latest time (null is earliest), then the smallest id. Aggregated before the shuffle, so that a group of
    any size costs one row per task."""
    best = F.max(F.struct("trust", "at", (-F.col("id")).alias("low"), "value")).alias("best")
    return values.groupBy("group_id", "field_name").agg(best).select("group_id", "field_name", (-F.col("best.low")).alias("id"), "best.value")


def normal(c: Column) -> Column:
    """Values that differ in case and blanks only make the same statement."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def facts(values: DataFrame) -> DataFrame:
    """(group_id, field_name, statement, yes array<source>, no array<source>): who claims a value and who has another."""
    said = values.select("group_id", "field_name", F.coalesce("source", F.lit("")).alias("source"), normal(F.col("value")).alias("statement")).distinct()
    who = said.groupBy("group_id", "field_name").agg(F.array_sort(F.collect_set("source")).alias("all"))
    yes = said.groupBy("group_id", "field_name", "statement").agg(F.array_sort(F.collect_set("source")).alias("yes"))
    return yes.join(who, ["group_id", "field_name"]).select("group_id", "field_name", "statement", "yes", F.array_except("all", "yes").alias("no"))


def judge(df: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(facts with probability, {source: (sensitivity, specificity)}) by expectation-maximisation.

    The facts stay in the cluster; between the rounds only four sums per source come to the driver. A value that the only source of its
    group and field claims has the prior's odds times that source's."""
    df = cut(df)
    sources = [r[0] for r in df.select(F.explode(F.concat("yes", "no")).alias("s")).distinct().limit(MOST_SOURCES + 1).collect()]
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    quality, prior = {s: (0.8, 0.7) for s in sources}, 0.6

    def posterior(d: DataFrame) -> DataFrame:
        if not quality:
            return d.withColumn("probability", F.lit(prior))
        def weights(f):
            return F.create_map(*chain.from_iterable((F.lit(s), F.lit(float(f(*q)))) for s, q in sorted(quality.items())))
        yes, no = weights(lambda a, b: math.log(a / (1 - b))), weights(lambda a, b: math.log((1 - a) / b))
        total = lambda c, m: F.aggregate(F.col(c), F.lit(0.0), lambda acc, s: acc + F.element_at(m, s))
        odds = F.lit(math.log(prior / (1 - prior))) + total("yes", yes) + total("no", no)
        return d.withColumn("probability", 1 / (1 + F.exp(-odds)))

    for _ in range(rounds):
        p = posterior(df)
        votes = p.select("probability", F.explode(F.concat(F.transform("yes", lambda s: F.struct(s.alias("s"), F.lit(1.0).alias("c"))), F.transform("no", lambda s: F.struct(s.alias("s"), F.lit(0.0).alias("c"))))).alias("v"))
        sums = votes.groupBy("v.s").agg(F.sum(F.expr("probability * v.c")).alias("tp"), F.sum("probability").alias("t"), F.sum(F.expr("(1 - probability) * (1 - v.c)")).alias("tn"), F.sum(F.expr("1 - probability")).alias("f")).collect()
        quality = {r.s: (min(0.99, max(0.01, (r.tp + 4) / (r.t + 5))), min(0.99, max(0.01, (r.tn + 3) / (r.f + 4)))) for r in sums}
        prior = min(0.95, max(0.05, p.agg(F.avg("probability")).first()[0] or 0.5)) if quality else prior
    return posterior(df), quality


def survivors(df: DataFrame, trust: DataFrame, group: str = "duplicate_group_id") -> DataFrame:
    """(group_id, field_name, id, value, probability, also array<string>): the kept value of each group and field with its probability of
    being true, and the group's other values judged true (probability over one half).

    Null groups are ungrouped and give no row; groups without a usable value in a field give no row for it; the same row twice counts
    once as a source; an empty table gives no row."""
    values = cut(candidates(df, trust, group))
    known, _ = judge(facts(values))
    best = kept(values).withColumn("statement", normal(F.col("value")))
    true = known.where("probability > 0.5").groupBy("group_id", "field_name").agg(F.array_sort(F.collect_set("statement")).alias("true"))
    got = best.join(known.select("group_id", "field_name", "statement", "probability"), ["group_id", "field_name", "statement"], "left")
    return got.join(true, ["group_id", "field_name"], "left").select("group_id", "field_name", "id", "value", "probability", F.array_except(F.coalesce("true", F.array().cast("array<string>")), F.array("statement")).alias("also"))
