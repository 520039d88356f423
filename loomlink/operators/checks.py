"""Contract checks. Each gives a table of violations (rule, ref, detail); require() raises if there are any."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlink.schemas import CAND, REF


def require(violations: DataFrame, what: str = "contract") -> None:
    """Raises ValueError with the first violations; drops nothing silently."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(f"{r['rule']} {r['ref']} {r['detail'] or ''}".strip() for r in found))


def rows(df: DataFrame, rule: str, ref: Column, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), ref.cast("string").alias("ref"), (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicates(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys that are null or occur more than once."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    ref = F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("NULL")) for k in keys])
    counted = df.groupBy(*keys).count()
    return union(rows(counted.where(null), rule + "_null", ref, F.col("count")), rows(counted.where(~null & (F.col("count") > 1)), rule + "_repeated", ref, F.col("count")))


def pair_keys(pairs: DataFrame) -> DataFrame:
    return duplicates(pairs, [REF, CAND], "pair")


def record_keys(records: DataFrame) -> DataFrame:
    return duplicates(records, ["entity_id"], "record")


def prefixes(pairs: DataFrame) -> DataFrame:
    """References start with S1-, candidates with S2- or S3-."""
    bad_ref = ~F.coalesce(F.startswith(F.col(REF), F.lit("S1-")), F.lit(False))
    bad_cand = ~F.coalesce(F.col(CAND).rlike("^S[23]-"), F.lit(False))
    return union(rows(pairs.where(bad_ref), "reference_prefix", F.col(REF), F.col(CAND)), rows(pairs.where(bad_cand), "candidate_prefix", F.col(REF), F.col(CAND)))


def id_format(records: DataFrame) -> DataFrame:
    return rows(records.where(~F.coalesce(F.col("entity_id").rlike(r"^S[123]-\d+$"), F.lit(False))), "id_format", F.col("entity_id"))


def scores(pairs: DataFrame, most: float = 1.050001) -> DataFrame:
    """Scores that aren't finite numbers from 0 to `most`."""
    s = F.col("score").cast("double")
    bad = s.isNull() | F.isnan(s) | (s < 0) | (s > most)
    return rows(pairs.where(bad), "score", F.col(REF), F.concat_ws(" ", CAND, F.col("score").cast("string")))


def normalized_values(df: DataFrame) -> DataFrame:
    """Violation counts by rule, in one pass."""
    form = r"^[a-z0-9]+( [a-z0-9]+)*$"
    rules = {
        "name_form": F.col("name_norm").isNotNull() & ~F.col("name_norm").rlike(form),
        "address_form": F.col("address_norm").isNotNull() & ~F.col("address_norm").rlike(form),
        "suffix_without_name": F.col("name_norm").isNull() & F.col("legal_suffix").isNotNull(),
        "id_null": F.col("entity_id").isNull(),
        "country_null": F.col("country").isNull(),
    }
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def too_many(pairs: DataFrame, most: int = 50) -> DataFrame:
    counted = pairs.groupBy(REF).count().where(F.col("count") > most)
    return rows(counted, "too_many_candidates", F.col(REF), F.col("count"))


def truth_coverage(truth: DataFrame, links: DataFrame, refs: DataFrame, targets: DataFrame) -> DataFrame:
    """Truth references equal the S1 records, and targets are among the candidates."""
    t, r = truth.select(F.col(REF).alias("id")).distinct(), refs.select(F.col("entity_id").alias("id")).distinct()
    known = targets.select(F.col("entity_id").alias(CAND))
    return union(
        rows(r.join(t, "id", "left_anti"), "reference_without_truth", F.col("id")),
        rows(t.join(r, "id", "left_anti"), "truth_without_reference", F.col("id")),
        rows(links.join(known, CAND, "left_anti"), "unknown_target", F.col(REF), F.col(CAND)),
    )


def ungrouped(lines: DataFrame) -> DataFrame:
    """References whose rows, in order of line_no, are in more than one run; one window per file order.

    Runs are found within slices of consecutive lines, so that no task holds the whole file.
    """
    from pyspark.sql import Window as W

    sliced = lines.withColumn("_slice", F.floor(F.col("line_no") / 1_000_000))
    prior = F.lag(REF).over(W.partitionBy("_slice").orderBy("line_no"))
    starts = sliced.withColumn("_prior", prior).where(F.col("_prior").isNull() | (F.col("_prior") != F.col(REF)))
    ends = sliced.groupBy("_slice").agg(F.min("line_no").alias("line_no"), F.min_by(REF, "line_no").alias("_ref"), F.max_by(REF, "line_no").alias("_end"))
    last = F.lag("_end").over(W.orderBy("_slice"))  # of the slice before that has lines; one row a million lines
    heads = ends.withColumn("_last", last).where("_ref = _last").select("line_no")
    counted = starts.join(heads, "line_no", "left_anti").groupBy(REF).count().where("count > 1")
    return rows(counted, "ungrouped", F.col(REF), F.col("count"))


def feature_contract(columns: list[str], wanted: list[str]) -> None:
    missing = [c for c in wanted if c not in columns]
    if missing:
        raise ValueError(f"feature columns are missing: {missing}")


def verify_outputs(matching: DataFrame, candidates: DataFrame, refs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Violations of result files, both as (ref, ids array): coverage, repeats, prefixes, subset and one owner per id."""
    both = matching.select("ref", "ids", F.lit("matching").alias("file")).unionByName(candidates.select("ref", "ids", F.lit("candidates").alias("file")))
    items = both.select("file", "ref", F.explode("ids").alias("id"))
    want = refs.select(F.col("entity_id").alias("ref"))
    parts = [rows(both.groupBy("file", "ref").count().where("count > 1"), "repeated_row", F.col("ref"), F.col("file"))]
    for name, table in (("matching", matching), ("candidates", candidates)):
        parts.append(rows(want.join(table, "ref", "left_anti"), "missing_reference", F.col("ref"), F.lit(name)))
        parts.append(rows(table.join(want, "ref", "left_anti"), "unknown_reference", F.col("ref"), F.lit(name)))
    parts.append(rows(items.groupBy("file", "ref", "id").count().where("count > 1"), "repeated_id", F.col("ref"), F.concat_ws(" ", "file", "id")))
    parts.append(rows(items.where("id like 'S1-%'"), "self_match", F.col("ref"), F.concat_ws(" ", "file", "id")))
    parts.append(rows(items.where("not id rlike '^S[123]-'"), "wrong_prefix", F.col("ref"), F.concat_ws(" ", "file", "id")))
    sets = matching.join(candidates.select("ref", F.col("ids").alias("of")), "ref")
    outside = sets.select("ref", F.explode(F.array_except("ids", "of")).alias("id"))
    parts.append(rows(outside, "not_a_candidate", F.col("ref"), F.col("id")))
    owners = items.where("file = 'matching'").groupBy("id").agg(F.count_distinct("ref").alias("n")).where("n > 1")
    parts.append(rows(owners, "several_owners", F.col("id"), F.col("n")))
    if known is not None:
        parts.append(rows(items.join(known.select(F.col("entity_id").alias("id")), "id", "left_anti"), "unknown_id", F.col("ref"), F.concat_ws(" ", "file", "id")))
    return union(*parts)


def id_lines(lines: DataFrame) -> DataFrame:
    """Violations of raw lines `ref<tab>ids` (value): tab, repeats, prefixes."""
    parts = F.split("value", "\t", 2)
    split = lines.select("value", parts[0].alias("ref"), F.get(parts, 1).alias("list"))
    good = split.where("list is not null")
    ids = F.filter(F.split("list", ","), lambda x: x != "")
    return union(
        rows(split.where("list is null"), "no_tab", F.col("value")),
        rows(good.groupBy("ref").count().where("count > 1"), "repeated_row", F.col("ref"), F.col("count")),
        rows(good.where(F.size(ids) > F.size(F.array_distinct(ids))), "repeated_id", F.col("ref"), F.col("list")),
        rows(good.where(F.exists(ids, lambda x: ~x.rlike("^S[23]-"))), "wrong_prefix", F.col("ref"), F.col("list")),
    )
