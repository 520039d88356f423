"""Blocking recall and metrics, truth tables and set comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.operators import checks
from loomlink.schemas import CAND, PAIR, REF


def truth_lists(df: DataFrame, on_duplicate: str = "union", trim: bool = True) -> DataFrame:
    """(ref, ids) from (source1_entity_id, matched_entity_ids); repeated references are united or rejected."""
    items = df.select(F.col(REF).alias("ref"), tx.id_list(F.col("matched_entity_ids"), trim).alias("ids"))
    if on_duplicate == "error":
        checks.require(checks.duplicates(items, ["ref"], "truth"), "truth")
        return items
    return items.groupBy("ref").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))


def truth_links(df: DataFrame) -> DataFrame:
    """Distinct (ref, cand)."""
    return df.select(REF, F.explode(tx.id_list(F.col("matched_entity_ids"))).alias(CAND)).distinct()


def per_reference(pairs: DataFrame, links: DataFrame, refs: DataFrame) -> DataFrame:
    """(ref, n_true, n_found, n_candidates) of refs (source1_entity_id)."""
    found = pairs.select(*PAIR).distinct().join(links.select(*PAIR, F.lit(1).alias("hit")), PAIR, "left").groupBy(REF).agg(F.count("*").alias("n_candidates"), F.count("hit").alias("n_found"))
    true = links.groupBy(REF).agg(F.count("*").alias("n_true"))
    out = refs.select(REF).distinct().join(true, REF, "left").join(found, REF, "left")
    return out.select(REF, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_true", "n_found", "n_candidates")])


def blocking_recall(pairs: DataFrame, links: DataFrame, refs: DataFrame) -> DataFrame:
    """One row: n_links, n_found, recall (0 without links)."""
    sums = per_reference(pairs, links, refs).agg(F.coalesce(F.sum("n_true"), F.lit(0)).alias("n_links"), F.coalesce(F.sum("n_found"), F.lit(0)).alias("n_found"))
    return sums.select("n_links", "n_found", F.when(F.col("n_links") > 0, F.col("n_found") / F.col("n_links")).otherwise(0.0).alias("recall"))


def blocking_metrics(pairs: DataFrame, links: DataFrame, refs: DataFrame) -> DataFrame:
    """One row of recall by link and by reference, and of candidate counts; recalls are NULL without links."""
    each = per_reference(pairs, links, refs)
    some = F.col("n_true") > 0
    return each.agg(
        F.count("*").alias("n_references"),
        F.count_if(~some).alias("n_singletons"),
        F.sum("n_true").alias("n_links"),
        F.sum("n_found").alias("n_found"),
        F.try_divide(F.sum("n_found").cast("double"), F.sum("n_true")).alias("micro_recall"),
        F.avg(F.when(some, F.col("n_found") / F.col("n_true"))).alias("macro_recall"),
        F.count_if(some & (F.col("n_found") == F.col("n_true"))).alias("n_whole"),
        F.count_if(some & (F.col("n_found") == 0)).alias("n_lost"),
        F.count_if(F.col("n_candidates") == 0).alias("n_without_candidates"),
        F.sum("n_candidates").alias("n_pairs"),
        F.min("n_candidates").alias("min_candidates"),
        F.max("n_candidates").alias("max_candidates"),
        F.avg("n_candidates").alias("mean_candidates"),
    )


def contested(links: DataFrame) -> DataFrame:
    """Candidates claimed by several references."""
    return links.groupBy(CAND).agg(F.count_distinct(REF).alias("n_refs")).where("n_refs > 1")
