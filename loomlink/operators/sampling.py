"""Linked samples and stratified splits, in an order that a hash of seed and id fixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.schemas import REF


def order_key(c: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")).cast("binary"))


def lowest_ids(df: DataFrame, n: int) -> DataFrame:
    """The n records of the smallest id numbers."""
    return df.orderBy(tx.id_number(F.col("entity_id")), "entity_id").limit(n)


def members_and_others(df: DataFrame, members: DataFrame, n: int, seed: int) -> DataFrame:
    """All records among members (entity_id) and n others, the first by hash."""
    others = df.join(members, "entity_id", "left_anti").orderBy(order_key(F.col("entity_id"), seed), "entity_id").limit(n)
    return df.join(members, "entity_id", "left_semi").unionByName(others)


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(order_key(F.col("entity_id"), seed), "entity_id")


def linked_sample(s1: DataFrame, pool: DataFrame, links: DataFrame, n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The first n references, and the pool's share: their true targets and n others for each source."""
    refs = lowest_ids(s1, n)
    wanted = links.join(refs.select(F.col("entity_id").alias(REF)), REF, "left_semi").select(F.col("candidate_entity_id").alias("entity_id")).distinct()
    return refs, members_and_others(pool, wanted, n, seed)


def proportional(df: DataFrame, n: int, total: DataFrame, seed: int) -> DataFrame:
    """round(rows * n / total) rows by hash, rounded half to even; total is a one-row table."""
    size = df.agg(F.count("*").alias("rows")).crossJoin(total.toDF("total")).select(F.bround(F.col("rows") * n / F.col("total")).cast("long").alias("take"))
    place = F.row_number().over(W.orderBy(order_key(F.col("entity_id"), seed), "entity_id"))
    top = df.orderBy(order_key(F.col("entity_id"), seed), "entity_id").limit(n)  # the share is never above n
    return top.withColumn("_place", place).crossJoin(F.broadcast(size)).where("_place <= take").drop("_place", "take")


def fit_rows(df: DataFrame, n: int, seed: int, id_col: str = "entity_id") -> DataFrame:
    """n rows without replacement (all, if fewer): the first by hash of seed and id.

    Rows are counted in 65,536 slices of the hash; slices before the n-th row are taken whole and only the one that
    holds it is ranked, so no task sorts the table.
    """
    sliced = df.withColumn("_key", order_key(F.col(id_col), seed)).withColumn("_slice", F.substr("_key", F.lit(1), F.lit(4)))
    counts = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.orderBy("_slice"))  # over the slices' counts
    places = F.broadcast(counts.select("_slice", upto.alias("_upto"), (upto - F.col("_n")).alias("_before")).where(F.col("_before") < n))
    met = sliced.join(places, "_slice")
    place = F.row_number().over(W.partitionBy("_slice").orderBy("_key", id_col))
    edge = met.where(F.col("_upto") > n).withColumn("_place", place).where(F.col("_before") + F.col("_place") <= n)
    return met.where(F.col("_upto") <= n).select(*df.columns).unionByName(edge.select(*df.columns))


def bucket(c: Column) -> Column:
    """0, 1 or 2+."""
    return F.when(c == 0, "0").when(c == 1, "1").otherwise("2+")


def match_counts(truth: DataFrame) -> DataFrame:
    """(ref, n_matches): distinct matches of each reference over all its rows."""
    each = truth.select(REF, F.explode_outer(tx.id_list(F.col("matched_entity_ids"))).alias("id"))
    return each.groupBy(REF).agg(F.count_distinct("id").alias("n_matches"))


def stratified_split(strata: DataFrame, share: float, seed: int) -> DataFrame:
    """strata (source1_entity_id, stratum) with is_validation: in each stratum round(share * n) by hash, half to even.

    Ranks within a stratum are counted in slices of the hash, so that one large stratum is spread over tasks.
    """
    key = order_key(F.col(REF), seed)
    sliced = strata.withColumn("_key", key).withColumn("_slice", F.substr(key, F.lit(1), F.lit(2)))
    counts = sliced.groupBy("stratum", "_slice").agg(F.count("*").alias("_n"))
    whole = W.partitionBy("stratum")
    starts = counts.select("stratum", "_slice", (F.sum("_n").over(whole.orderBy("_slice")) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("_all"))
    ranked = sliced.withColumn("_rank", F.row_number().over(W.partitionBy("stratum", "_slice").orderBy("_key", REF))).join(starts, ["stratum", "_slice"])
    return ranked.select(*strata.columns, (F.col("_before") + F.col("_rank") <= F.bround(share * F.col("_all"))).alias("is_validation"))


def split_summary(strata: DataFrame) -> DataFrame:
    """(country, bucket, n, share) with a subtotal for each country and a total."""
    total = strata.agg(F.count("*").alias("total"))
    rolled = strata.rollup("country", "bucket").agg(F.count("*").alias("n"))
    return rolled.crossJoin(F.broadcast(total)).select("country", "bucket", "n", (F.col("n") / F.col("total")).alias("share"))
