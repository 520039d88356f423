"""Linkage tables derived from the driver's documents: the same rules in DataFrames here and in SQL in plans/oracle.py."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.session import once


def _kept(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The table is derived once in a session and folder."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return once(f"{f.__name__} {sf_dir}", lambda: f(spark, sf_dir), spark)

    return run


def _normalized(c: str) -> Column:
    return tx.normalize_text(F.col(c), tx.join_initials_in_pairs)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, src, entity_id, business_name, business_address, country."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    words = F.filter(F.split(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")), " "), lambda w: w != "")
    legal = F.element_at(F.array(*map(F.lit, [" Ltd.", " Inc", " Pvt. Ltd.", "", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    docs = docs.withColumn("w", words).withColumn("src", F.substr("source", F.lit(4)).cast("int") % 3 + 1)
    return docs.select(
        "doc_id",
        "src",
        F.concat(F.lit("S"), F.col("src"), F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.concat(F.array_join(F.slice("w", 1, 4), " "), legal).alias("business_name"),
        F.when(F.col("doc_id") % 29 == 0, "").otherwise(F.array_join(F.slice("w", 5, 6), " ")).alias("business_address"),
        F.when(F.col("lang") == "en", "US").when(F.col("lang") == "fr", "France").otherwise("India").alias("country"),
    )


@_kept
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized records with doc_id and src."""
    base = raw(spark, sf_dir)
    name, suffix = tx.split_suffix(F.col("_n"))
    base = base.withColumn("_n", _normalized("business_name"))
    return base.select("doc_id", "src", "entity_id", name.alias("name_norm"), suffix.alias("legal_suffix"), _normalized("business_address").alias("address_norm"), "country")


@_kept
def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, src, entity_id, key): the key is the first eight words of the whole text, normalized."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = F.split(_normalized("text"), " ")
    keys = docs.select("doc_id", F.array_join(F.slice(words, 1, 8), " ").alias("key"))
    return raw(spark, sf_dir).select("doc_id", "src", "entity_id").join(keys, "doc_id")


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records with their key, and the first S1 record (ref) of each key."""
    base = keyed(spark, sf_dir)
    owners = base.where("src = 1 and key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "entity_id"))["entity_id"].alias("ref"))
    return base, owners


@_kept
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (source1_entity_id, candidate_entity_id): each key's first S1 record with all other records of the key."""
    base, owners = _keyed(spark, sf_dir)
    return owners.join(base.where("src > 1"), "key").select(F.col("ref").alias("source1_entity_id"), F.col("entity_id").alias("candidate_entity_id")).distinct()


@_kept
def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): records of one key belong to its first S1 record."""
    base, owners = _keyed(spark, sf_dir)
    targets = base.where("src > 1").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("doc_id", "entity_id"))).alias("t"))
    lists = owners.join(targets, "key").select("ref", F.array_join(F.col("t.entity_id"), ",").alias("ids"))
    refs = base.where("src = 1").select(F.col("entity_id").alias("ref"))
    return refs.join(lists, "ref", "left").select(F.col("ref").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


@_kept
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, score, probability, label, r, c): all links, and pairs within blocks of 100 ids."""
    base = raw(spark, sf_dir).select("doc_id", "src", "entity_id")
    left = base.where("src = 1").select(F.col("entity_id").alias("source1_entity_id"), F.col("doc_id").alias("r"), F.floor(F.col("doc_id") / 100).alias("block"))
    right = base.where("src > 1").select(F.col("entity_id").alias("candidate_entity_id"), F.col("doc_id").alias("c"), F.floor(F.col("doc_id") / 100).alias("block"))
    known = links(spark, sf_dir)
    linked = known.join(left.drop("block"), "source1_entity_id").join(right.drop("block"), "candidate_entity_id")
    names = ["source1_entity_id", "candidate_entity_id", "r", "c"]
    pairs = left.join(right, "block").select(*names).union(linked.select(*names)).distinct()
    pairs = pairs.join(known.withColumn("label", F.lit(1)), names[:2], "left")
    return pairs.select(
        "source1_entity_id",
        "candidate_entity_id",
        ((F.col("r") * 7919 + F.col("c") * 104729) % 1000 / F.lit(1000.0)).alias("score"),
        ((F.col("r") * 31 + F.col("c") * 17) % 1000 / F.lit(1000.0)).alias("probability"),
        F.coalesce("label", F.lit(0)).alias("label"),
        "r",
        "c",
    )


@_kept
def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame that decisions are taken on."""
    rec = records(spark, sf_dir)
    side = lambda p: rec.select(F.col("entity_id").alias(f"{p}_entity_id"), F.col("address_norm").isNull().alias(f"{p}_no"), F.col("country").alias(f"{p}_country"))
    pairs = scored(spark, sf_dir).join(side("source1"), "source1_entity_id").join(side("candidate"), "candidate_entity_id")
    both = ~F.col("source1_no") & ~F.col("candidate_no")
    return pairs.select(
        "source1_entity_id",
        "candidate_entity_id",
        "probability",
        F.when(both, (F.col("r") + F.col("c")) % 100 / F.lit(100.0)).alias("address_tfidf_cosine"),
        F.when(both, (F.col("r") * 3 + F.col("c")) % 100 / F.lit(100.0)).alias("address_token_sort"),
        F.col("source1_no").cast("double").alias("source1_address_missing"),
        F.col("candidate_no").cast("double").alias("candidate_address_missing"),
        "source1_country",
        "candidate_country",
        "label",
    )
