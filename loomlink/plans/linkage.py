"""The linkage programs: candidates, handoff of features, inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.operators import blocking, checks, decision, evaluate, features, sampling
from loomlink.operators.model import Matcher, leave_one_country_out
from loomlink.schemas import CAND, FEATURE_VERSION, PAIR, REF, SCORED_FEATURES
from loomlink.sources import io


def _new_folder(spark: SparkSession, path: str) -> None:
    if io.exists(spark, path):
        raise FileExistsError(path)


def normalize(spark: SparkSession, raw_paths: list[str], out: str) -> dict[str, int]:
    """Raw TSV files to normalized Parquet; raises if a value breaks the rules."""
    made = tx.normalize_records(io.read_tsv(spark, raw_paths), any_script=True)
    counts = io.write_records(made, out, ["entity_id", "name_norm", "legal_suffix", "address_norm", "country"])
    bad = checks.normalized_values(spark.read.parquet(out)).where("violations > 0")
    checks.require(checks.rows(bad, "normalized", F.col("rule"), F.col("violations")), "normalized")
    return counts


def block(s1: DataFrame, pool: DataFrame, out: str, k: int = 50) -> None:
    """Scored pairs and id lists of the k best candidates."""
    _new_folder(s1.sparkSession, out)
    pairs = blocking.retrieve_candidates(s1, pool, k, digits=6)
    pairs.write.parquet(f"{out}/pairs")
    pairs = s1.sparkSession.read.parquet(f"{out}/pairs")
    io.write_tsv(io.scored_lines(pairs), f"{out}/candidate_pairs")
    io.write_tsv(io.id_lists(pairs, s1.select(F.col("entity_id").alias(REF)), F.asc("rank")), f"{out}/candidates")


def split(truth: DataFrame, records: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """(ref, stratum, is_validation): by country and number of matches."""
    counts = sampling.match_counts(truth).join(records.select(F.col("entity_id").alias(REF), "country"), REF, "left")
    strata = counts.select(REF, F.concat_ws("|", F.coalesce("country", F.lit("UNKNOWN")), sampling.bucket(F.col("n_matches"))).alias("stratum"))
    return sampling.stratified_split(strata, share, seed)


def handoff(records: DataFrame, truth: DataFrame, parts: dict[str, DataFrame], pairs: DataFrame, out: str, most: int = 50) -> dict:
    """Features, labels, truth and id lists for each part (references), and a manifest written last."""
    _new_folder(records.sparkSession, out)
    links = evaluate.truth_links(truth)
    s1, targets = records.where("entity_id like 'S1-%'"), records.where("not entity_id like 'S1-%'")
    checks.require(checks.record_keys(records), "records")
    checks.require(checks.truth_coverage(truth, links, s1, targets), "truth")
    names = list(parts)
    for k, name in enumerate(names):
        for other in names[k + 1 :]:
            both = parts[name].select(REF).intersect(parts[other].select(REF))
            checks.require(checks.rows(both, "part_overlap", F.col(REF)), f"{name}, {other}")
    ranked = features.add_retrieval_features(pairs)
    checks.require(checks.too_many(ranked, most), "pairs")
    joined = features.join_pairs(ranked, records)
    extractor = features.FeatureExtractor().fit(features.training_corpus(records, parts[names[0]], links))
    extractor.save(f"{out}/extractor")
    told = {"version": FEATURE_VERSION, "features": SCORED_FEATURES, "parts": {}}
    kept = ["blocking_score", "candidate_rank", "blocking_top1_top2_gap"]
    for name, refs in parts.items():
        own = joined.join(refs.select(REF), REF, "left_semi")
        made = extractor.transform(own).join(own.select(*PAIR, *[F.col(c).cast("float").alias(c) for c in kept]), PAIR)
        counts = io.write_records(made, f"{out}/{name}/features", [*PAIR, *SCORED_FEATURES])
        labels = own.select(*PAIR).join(links.withColumn("label", F.lit(1)), PAIR, "left").select(*PAIR, F.coalesce("label", F.lit(0)).alias("label"))
        labels.write.parquet(f"{out}/{name}/labels")
        truth.join(refs.select(REF), REF, "left_semi").write.parquet(f"{out}/{name}/truth")
        io.write_ids(refs.select(REF), f"{out}/{name}/ids")
        io.write_tsv(io.id_lists(own.withColumnRenamed("blocking_score", "score"), refs, F.asc("candidate_rank")), f"{out}/{name}/candidates")
        told["parts"][name] = counts | evaluate.blocking_metrics(own, links, refs).first().asDict()
    io.write_manifest(records.sparkSession, f"{out}/manifest.json", told | {"files": io.digests(records.sparkSession, out)})
    return told


def score_pairs(pairs: DataFrame, records: DataFrame, extractor: features.FeatureExtractor, model: Matcher) -> DataFrame:
    """The decision frame of scored pairs."""
    joined = features.join_pairs(features.add_retrieval_features(pairs), records)
    made = extractor.transform(joined).join(joined.select(*PAIR, "blocking_score", "candidate_rank", "blocking_top1_top2_gap"), PAIR)
    country = lambda p, key: records.select(F.col("entity_id").alias(key), F.col("country").alias(f"{p}_country"))
    return model.predict(made).join(country("source1", REF), REF, "left").join(country("candidate", CAND), CAND, "left")


def infer(s1: DataFrame, pool: DataFrame, pairs: DataFrame, extractor: features.FeatureExtractor, model: Matcher, threshold: float, out: str, rule: decision.Corroboration | None = None) -> dict:
    """Matching and candidate files for every reference, verified, with a summary written last."""
    _new_folder(s1.sparkSession, out)
    spark, records = s1.sparkSession, io.pool(s1, pool)
    refs = s1.select(F.col("entity_id").alias(REF))
    score_pairs(pairs, records, extractor, model).write.parquet(f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    accepted = decision.decide(scored, threshold, rule or decision.Corroboration())
    matching = io.id_lists(accepted, refs, F.desc("probability"), F.asc(CAND), name="matched_entity_ids")
    candidates = io.id_lists(scored, refs, F.asc("candidate_rank"))
    lists = lambda df: df.select(F.col(REF).alias("ref"), tx.id_list(F.col(df.columns[1])).alias("ids"))
    checks.require(checks.verify_outputs(lists(matching), lists(candidates), s1, pool), "outputs")
    io.write_tsv(matching, f"{out}/matching")
    io.write_tsv(candidates, f"{out}/candidates")
    rates = match_rates(decision.to_predictions(accepted, refs), s1).collect()
    told = {"threshold": threshold, "references": s1.count(), "accepted": accepted.count(), "match_rate": {r["country"]: r["match_rate"] for r in rates}}
    io.write_manifest(spark, f"{out}/summary.json", told | {"files": io.digests(spark, out)})
    return told


def hold_out(df: DataFrame, truth: DataFrame, train: str, test: str, out: str, **options) -> dict:
    """Fits on one country and exports the other's scored pairs, the sweep by threshold and the best one, in a new folder.

    df has features, label and source1_country; truth is (ref, ids).
    """
    spark = df.sparkSession
    _new_folder(spark, out)
    fitted, swept, best = leave_one_country_out(df, truth, train, test, **options)
    fitted.predict(df.where(F.col("source1_country") == test)).select(*PAIR, "label", "probability").write.parquet(f"{out}/pairs")
    io.write_tsv(swept.orderBy("threshold").coalesce(1), f"{out}/sweep")  # a row for each threshold of the grid
    told = {"train": train, "test": test, "best": best.first().asDict()}
    io.write_manifest(spark, f"{out}/summary.json", told | {"files": io.digests(spark, out)})
    return told


def match_rates(predictions: DataFrame, s1: DataFrame) -> DataFrame:
    """(country, n, match_rate)."""
    met = predictions.join(s1.select(F.col("entity_id").alias("ref"), "country"), "ref")
    return met.groupBy("country").agg(F.count("*").alias("n"), F.avg((F.size("ids") > 0).cast("int")).alias("match_rate"))


def fixture_pairs(truth: DataFrame, targets: DataFrame) -> DataFrame:
    """(ref, cand, label): true links, and for each reference the first target that is none of them.

    A reference of n links has its first non-match among the first n + 1 targets, so only as many as the longest list
    asks for are met.
    """
    lists = evaluate.truth_lists(truth)
    most = lists.agg(F.max(F.size("ids"))).first()[0] or 0
    few = targets.select(F.col("entity_id").alias(CAND)).orderBy(CAND).limit(most + 1)
    few = few.agg(F.array_sort(F.collect_list(CAND)).alias("few"))
    links = lists.select(F.col("ref").alias(REF), F.explode("ids").alias(CAND), F.lit(1).alias("label"))
    first = F.get(F.array_except(F.slice("few", 1, F.size("ids") + 1), "ids"), F.lit(0))
    other = lists.crossJoin(F.broadcast(few)).select(F.col("ref").alias(REF), first.alias(CAND), F.lit(0).alias("label")).where(F.col(CAND).isNotNull())
    return links.unionByName(other)
