"""The pN_ queries: each takes (spark, sf_dir), reads whole tables and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import abuse, addresses, categories, encoding, leakage, linkage, mixing, names, survivors
from .common import cut, table, usable_domain, usable_phone
from .components import components, key_edges


# --- 1: addresses of one place


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of ungrouped leads at one place whose addresses are written differently."""
    return addresses.same_place(table(spark, sf, "cleaned_enriched"))


def p1_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    """The abbreviations and spellings mined from the leads' addresses: those that p1_found applies."""
    leads = table(spark, sf, "cleaned_enriched").where("duplicate_group_id is null").select("source_row_id", "address", "city", usable_phone("phone_e164").alias("phone"), usable_domain("website_domain").alias("domain"))
    rows = cut(addresses.parsed(leads, "source_row_id", "address", "city", "phone", "domain"))
    known, _ = addresses.mine(addresses._towns(rows))
    return spark.createDataFrame(sorted(known), "place string, written string, meant string")


# --- 2: variant names


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of ungrouped leads that name one organisation, or one person of it, differently."""
    return names.variants(table(spark, sf, "cleaned_enriched"), table(spark, sf, "shared_domains"))


# --- 3: damaged text


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values of business_name and address damaged by a wrong encoding."""
    leads = table(spark, sf, "cleaned_enriched").select("source_row_id", "business_name", "address")
    return encoding.find_damage(leads, "source_row_id", ["business_name", "address"]).select("source_row_id", "field_name")


def p3_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged values with the text as it was meant; U+FFFD where a letter cannot be known."""
    leads = table(spark, sf, "cleaned_enriched").select("source_row_id", "business_name", "address")
    return encoding.find_damage(leads, "source_row_id", ["business_name", "address"])


# --- 4: typed categories


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry of category_ref that each typed category means, -1 if none."""
    return categories.map_to_reference(table(spark, sf, "cleaned_enriched"), "source_row_id", "category", table(spark, sf, "category_ref")).select("source_row_id", "ref_id")


def p4_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Every lead with a category: its entry, label and the canonical category that follows; nulls where nothing fits."""
    ref = table(spark, sf, "category_ref")
    got = categories.map_to_reference(table(spark, sf, "cleaned_enriched"), "source_row_id", "category", ref, keep_exact=True)
    return got.join(ref.select("ref_id", "label", "canonical_category"), "ref_id", "left").select("source_row_id", "ref_id", "label", "canonical_category", F.round("similarity", 3).alias("similarity"), "how")


def p4_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """The typed values that fit no entry, with their numbers of rows."""
    leads = table(spark, sf, "cleaned_enriched").select("source_row_id", "category")
    got = categories.map_to_reference(leads, "source_row_id", "category", table(spark, sf, "category_ref"))
    return leads.join(got.where("ref_id = -1").select("source_row_id"), "source_row_id").groupBy("category").agg(F.count("*").alias("rows"))


# --- 5: groups of linked leads


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """The group of every lead that is linked to another."""
    shared = table(spark, sf, "shared_domains").select(F.lower(F.trim("domain")).alias("shared")).distinct()
    leads = table(spark, sf, "cleaned_enriched").select("source_row_id", usable_phone("phone_e164").alias("phone"), usable_domain("website_domain").alias("domain"))
    leads = leads.join(shared, F.col("domain") == F.col("shared"), "left").select("source_row_id", "phone", F.when(F.col("shared").isNull(), F.col("domain")).alias("domain"))
    pairs = table(spark, sf, "match_pairs").where("verdict = 'match'").select(F.col("source_row_id_a").alias("a"), F.col("source_row_id_b").alias("b"))
    got = components(key_edges(leads.where("phone is not null or domain is not null"), "source_row_id", ["phone", "domain"]).union(pairs))
    return got.select(F.col("id").alias("source_row_id"), "group_id")


# --- 6: leads and provider records


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.matches(table(spark, sf, "cleaned_enriched"), table(spark, sf, "provider_orgs"), table(spark, sf, "shared_domains"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Ungrouped leads and provider records that are one business."""
    return _linked(spark, sf).select("source_row_id", "org_id")


def p6_confidence(spark: SparkSession, sf: str) -> DataFrame:
    """The matches with their confidence, a calibrated probability."""
    return _linked(spark, sf)


# --- 7: survivors


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """The member whose value is kept, by group and field."""
    got = survivors.survivors(table(spark, sf, "cleaned_enriched"), table(spark, sf, "source_trust"))
    return got.select(F.col("group_id").alias("duplicate_group_id"), "field_name", F.col("id").alias("source_row_id"))


def p7_record(spark: SparkSession, sf: str) -> DataFrame:
    """One surviving record for each group: the kept values, and all phones and domains judged true."""
    got = survivors.survivors(table(spark, sf, "cleaned_enriched"), table(spark, sf, "source_trust"))
    kept = [F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in survivors.FIELDS]
    more = [F.max(F.when(F.col("field_name") == f, F.array_join("also", "; "))).alias(f"other_{f}") for f in ("phone_e164", "website_domain")]
    return got.groupBy(F.col("group_id").alias("duplicate_group_id")).agg(*kept, *more)


def p7_sources(spark: SparkSession, sf: str) -> DataFrame:
    """What the model thinks of each source: its sensitivity and specificity."""
    values = survivors.candidates(table(spark, sf, "cleaned_enriched"), table(spark, sf, "source_trust"))
    _, quality = survivors.judge(survivors.facts(values))
    return spark.createDataFrame([(s, *map(float, q)) for s, q in sorted(quality.items())], "source_file string, sensitivity double, specificity double")


# --- 8: leaked evaluation items


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that give evaluation items away."""
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every item: in how many documents it leaked, and the most that one of them holds."""
    got = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).groupBy("item_id").agg(F.count("*").alias("documents"), F.round(F.max("passage_share"), 4).alias("passage_share"), F.round(F.max("question_share"), 4).alias("question_share"))
    return table(spark, sf, "eval_items").select("item_id", "suite").join(got, "item_id", "left").fillna(0, ["documents"]).fillna(0.0, ["passage_share", "question_share"])


# --- 9: sources mixed to shares


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The texts of the mixture, with how often each is used."""
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The share that each source was to have, and has."""
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[1]


# --- 10: abusive texts


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that insult, threaten, degrade or are sexually explicit."""
    return abuse.abusive(table(spark, sf, "documents")).select("doc_id")


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The score of every document, with its worst clause."""
    return abuse.scored(table(spark, sf, "documents"))


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The rate of bad documents per source."""
    return abuse.rates(table(spark, sf, "documents"))


QUERIES = {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit() and callable(v)}
