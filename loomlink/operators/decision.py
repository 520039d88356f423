"""Decisions on scored pairs: threshold, one owner for each candidate, then guards. NaN counts as missing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.functions.similarity import f_beta, is_close
from loomlink.schemas import CAND, PAIR, REF


@dataclass(frozen=True)
class Corroboration:
    """Floors of address evidence (fixed values by default)."""

    min_address_cosine: float = 0.10
    min_address_token_sort: float = 0.45
    missing_address_min_probability: float = 0.80


def known(c: str) -> Column:
    """A number, or NULL where it is NaN."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def valve(pairs: DataFrame, threshold: float | Column) -> DataFrame:
    """Pairs of at least the threshold; a reference with none keeps nothing."""
    return pairs.where(known("probability") >= threshold)


def valve_by_group(pairs: DataFrame, threshold: float) -> DataFrame:
    """The same with the group's maximum spelled out."""
    best = F.max(known("probability")).over(W.partitionBy(REF))
    return pairs.withColumn("_best", best).where((F.col("_best") >= threshold) & (known("probability") >= threshold)).drop("_best")


def assign(pairs: DataFrame, *within: str) -> DataFrame:
    """Each candidate to its most probable reference, ties to the smallest id."""
    order = W.partitionBy(*within, CAND).orderBy(F.desc_nulls_last(known("probability")), REF)
    return pairs.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def address_missing() -> Column:
    flags = (F.col("source1_address_missing") == 1) | (F.col("candidate_address_missing") == 1)
    return F.coalesce(flags, F.lit(False)) | known("address_tfidf_cosine").isNull() | known("address_token_sort").isNull()


def corroborated(pairs: DataFrame, rule: Corroboration) -> DataFrame:
    """Without pairs that rest on the name alone."""
    low = (known("address_tfidf_cosine") < rule.min_address_cosine) & (known("address_token_sort") < rule.min_address_token_sort)
    weak = address_missing() & (known("probability") < rule.missing_address_min_probability)
    return pairs.where(~F.coalesce((~address_missing() & low) | weak, F.lit(False)))


def country_of(c: str) -> Column:
    return F.nullif(F.lower(tx.strip(F.col(c))), F.lit(""))


def country_veto(pairs: DataFrame) -> DataFrame:
    """Without pairs whose countries are both known and differ."""
    return pairs.where(F.coalesce(country_of("source1_country") == country_of("candidate_country"), F.lit(True)))


def decide(pairs: DataFrame, threshold: float, rule: Corroboration | None = None, veto: bool = True) -> DataFrame:
    """Threshold, assignment, guards; a guard never hands a candidate on."""
    out = assign(valve(pairs, threshold))
    out = corroborated(out, rule) if rule else out
    return country_veto(out) if veto else out


def to_predictions(accepted: DataFrame, refs: DataFrame) -> DataFrame:
    """(ref, ids) of every reference (source1_entity_id), sorted, empty where nothing is accepted."""
    sets = accepted.groupBy(REF).agg(F.array_sort(F.collect_set(CAND)).alias("ids"))
    return refs.select(REF).join(sets, REF, "left").select(F.col(REF).alias("ref"), F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def grid(spark) -> DataFrame:
    """Thresholds 0.02 to 0.98 by 0.01."""
    return spark.range(2, 99).select((F.col("id") / 100.0).alias("threshold"))


def funnel(pairs: DataFrame, threshold: float, rule: Corroboration) -> DataFrame:
    """(stage, n_pairs, n_true): pairs left after each step."""
    steps = [("0_all", pairs)]
    steps.append(("1_threshold", valve(pairs, threshold)))
    steps.append(("2_assigned", assign(steps[-1][1])))
    steps.append(("3_corroborated", corroborated(steps[-1][1], rule)))
    steps.append(("4_country", country_veto(steps[-1][1])))
    counts = [df.agg(F.count("*").alias("n_pairs"), F.sum("label").cast("long").alias("n_true")).select(F.lit(s).alias("stage"), "n_pairs", F.coalesce("n_true", F.lit(0)).cast("long").alias("n_true")) for s, df in steps]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def reference_scores(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(ref, f) of every reference of truth; both tables (ref, ids). Others are left out, missing ones count as empty."""
    none = F.array().cast("array<string>")
    met = truth.select("ref", F.array_distinct("ids").alias("t")).join(predicted.select("ref", F.array_distinct("ids").alias("p")), "ref", "left").withColumn("p", F.coalesce("p", none))
    return met.select("ref", f_beta(F.size(F.array_intersect("p", "t")).cast("double"), F.size("p"), F.size("t")).alias("f"))


def macro_score(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: macro_f, NULL for an empty truth (which score() rejects)."""
    return reference_scores(predicted, truth).agg(F.avg("f").alias("macro_f"))


def score(predicted: DataFrame, truth: DataFrame) -> float:
    found = macro_score(predicted, truth).first()["macro_f"]
    if found is None:
        raise ValueError("ground truth is empty")
    return found


def sweep(pairs: DataFrame, truth: DataFrame, thresholds: DataFrame, decide_fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(threshold, macro_f): the decision at every threshold at once.

    Without decide_fn, a candidate goes to its best pair, whatever the threshold, so pairs are assigned once. A reference's
    score is constant between the levels (the largest thresholds not over a probability) of its pairs; its steps are
    summed by level, and a threshold's total is the sum of the steps at its level and above.

    decide_fn takes pairs with a threshold column, of at least that threshold already, and must keep it; then pairs are
    copied for each threshold. References without a prediction are reckoned from the truth alone.
    """
    links = truth.select(F.col("ref").alias(REF), F.explode("ids").alias(CAND)).distinct().withColumn("hit", F.lit(1))
    n_true = truth.select(F.col("ref").alias(REF), F.size(F.array_distinct("ids")).alias("t"))
    base = n_true.agg(F.count("*").alias("n"), F.count_if(F.col("t") == 0).alias("single"))
    score = lambda tp, p: f_beta(F.col(tp).cast("double"), F.col(p), F.col("t"))
    if decide_fn is None:
        every = thresholds.agg(F.array_sort(F.collect_set("threshold")).alias("_every"))
        level = F.try_element_at(F.filter("_every", lambda x: x <= F.col("probability")), F.lit(-1))
        own = assign(pairs.where(known("probability").isNotNull())).crossJoin(F.broadcast(every)).withColumn("level", level).where("level is not null")
        own = own.select(*PAIR, "level").groupBy(*PAIR).agg(F.max("level").alias("level")).join(links, PAIR, "left")
        counts = own.groupBy(REF, "level").agg(F.count("*").alias("p"), F.count("hit").alias("tp")).join(n_true, REF)
        above = W.partitionBy(REF).orderBy(F.desc("level"))
        steps = counts.withColumns({c: F.sum(c).over(above.rowsBetween(W.unboundedPreceding, 0)) for c in ("p", "tp")})
        steps = steps.withColumn("f", score("tp", "p")).withColumn("before", F.lag("f").over(above))
        steps = steps.groupBy("level").agg(F.sum(F.col("f") - F.coalesce("before", F.lit(0.0))).alias("s"), F.count_if((F.col("t") == 0) & F.col("before").isNull()).alias("wrong"))
        total = W.orderBy(F.desc("threshold")).rowsBetween(W.unboundedPreceding, 0)  # one row a threshold
        made = thresholds.join(steps.withColumnRenamed("level", "threshold"), "threshold", "left").withColumns({c: F.sum(F.coalesce(c, F.lit(0))).over(total) for c in ("s", "wrong")})
    else:
        at = decide_fn(pairs.crossJoin(F.broadcast(thresholds)).where(known("probability") >= F.col("threshold")))
        counts = at.select("threshold", *PAIR).distinct().join(links, PAIR, "left").groupBy("threshold", REF).agg(F.count("*").alias("p"), F.count("hit").alias("tp"))
        f = counts.join(n_true, REF).groupBy("threshold").agg(F.sum(score("tp", "p")).alias("s"), F.count_if(F.col("t") == 0).alias("wrong"))
        made = thresholds.join(f, "threshold", "left")
    made = made.crossJoin(F.broadcast(base))
    return made.select("threshold", ((F.coalesce("s", F.lit(0.0)) + F.col("single") - F.coalesce("wrong", F.lit(0))) / F.col("n")).alias("macro_f"))


def best_threshold(swept: DataFrame) -> DataFrame:
    """One row: the largest threshold that is as good as the best."""
    top = swept.agg(F.max("macro_f").alias("top"))
    return swept.crossJoin(F.broadcast(top)).where(is_close(F.col("macro_f"), F.col("top"))).agg(F.max("threshold").alias("threshold"), F.max("macro_f").alias("macro_f"))


def reliability(pairs: DataFrame) -> DataFrame:
    """(bin, n, mean_probability, positive_rate) over six left-closed bins; empty ones are left out."""
    edges = [0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0001]
    p = known("probability")
    bins = F.lit(None).cast("int")
    for k in range(6):
        bins = F.when((p >= edges[k]) & (p < edges[k + 1]), k).otherwise(bins)
    rows = pairs.withColumn("bin", bins).where("bin is not null")
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.avg("probability").alias("mean_probability"), F.avg("label").alias("positive_rate"))
