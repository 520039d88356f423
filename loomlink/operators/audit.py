"""Audits of raw tables and of the ground truth, each in one pass where one will do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlink.functions import text as tx
from loomlink.schemas import CAND, REF

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def source_counts(df: DataFrame, prefix: str) -> DataFrame:
    """One row of counts over raw records: form and prefix of ids, and empty, blank, null-like and odd fields."""
    aggs = [
        F.count("*").alias("n_rows"),
        F.count_if(~F.coalesce(F.col("entity_id").rlike(r"^S[123]-\d+$"), F.lit(False))).alias("malformed_id"),
        F.count_if(~F.coalesce(F.startswith(F.col("entity_id"), F.lit(prefix)), F.lit(False))).alias("wrong_prefix"),
    ]
    for c in COLUMNS:
        v = F.coalesce(F.col(c), F.lit(""))
        aggs += [
            F.count_if(v == "").alias(f"{c}_empty"),
            F.count_if((v != "") & (tx.strip(v) == "")).alias(f"{c}_blank"),
            F.count_if((v != "") & F.lower(tx.strip(v)).isin([t for t in tx.NULL_TOKENS if t])).alias(f"{c}_null_like"),
            F.count_if(v.contains('"')).alias(f"{c}_quotes"),
            F.count_if(v.rlike("[\\x00-\\x1F\\x7F]")).alias(f"{c}_control"),
            F.count_if(v.rlike("[^\\x00-\\x7F]")).alias(f"{c}_non_ascii"),
        ]
    return df.agg(*aggs)


def raw_lines(spark, path: str, columns: int = 4) -> DataFrame:
    """One row of counts over the file's bytes: lines, CRLF, BOM, invalid UTF-8, wrong numbers of columns."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("b"))
    text = F.decode(F.col("b"), F.lit("ISO-8859-1"))
    return lines.agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.octet_length("b") == 0).alias("blank"),
        F.count_if(F.endswith(text, F.lit("\r"))).alias("crlf"),
        F.count_if(F.startswith(text, F.lit("ï»¿"))).alias("bom"),
        F.count_if(~F.is_valid_utf8(F.col("b").cast("string"))).alias("invalid_utf8"),
        F.count_if((F.octet_length("b") > 0) & (F.size(F.split(text, "\t")) != columns)).alias("wrong_columns"),
    )


def column_histogram(lines: DataFrame) -> DataFrame:
    """(n_columns, n) of tab-separated lines (value)."""
    return lines.select((F.regexp_count("value", F.lit("\t")) + 1).cast("long").alias("n_columns")).groupBy("n_columns").agg(F.count("*").alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def duplicate_ids(df: DataFrame) -> DataFrame:
    """One row: repeated rows, ids affected, the most rows of one id, and the first five such ids."""
    many = df.groupBy("entity_id").agg(F.count("*").alias("n")).where("n > 1")
    first = many.orderBy("entity_id").limit(5).agg(F.array_sort(F.collect_list("entity_id")).alias("ids"))
    sums = many.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeat_rows"), F.count("*").alias("ids_affected"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    return sums.crossJoin(F.broadcast(first)).select("repeat_rows", "ids_affected", "most", F.array_join("ids", ",").alias("examples"))


def truth_counts(truth: DataFrame, refs: DataFrame, pool: DataFrame) -> DataFrame:
    """One row of counts over the ground truth: sizes of lists, unknown and repeated items, shared targets, unmatched."""
    raw_items = F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")
    sized = truth.select(REF, tx.id_list(F.col("matched_entity_ids")).alias("ids"), raw_items.alias("raw"), (F.coalesce("matched_entity_ids", F.lit("")) != "").alias("some"))
    lists = sized.agg(
        F.count("*").alias("n_refs"),
        F.count_if(F.size("ids") == 0).alias("n_zero"),
        F.count_if(F.size("ids") == 1).alias("n_one"),
        F.count_if(F.size("ids") >= 2).alias("n_more"),
        F.max(F.size("ids")).cast("long").alias("most"),
        F.count_if(F.size("ids") > F.size(F.array_distinct("ids"))).alias("repeated_in_list"),
        F.count_if(F.col("some") & F.exists("raw", lambda x: F.trim(x) == "")).alias("empty_item"),
        F.count_if(F.exists("ids", lambda x: ~x.rlike("^S[23]-"))).alias("wrong_prefix"),
        F.count_if(~F.coalesce(F.startswith(F.col(REF), F.lit("S1-")), F.lit(False))).alias("wrong_reference"),
    )
    links = sized.select(REF, F.explode("ids").alias(CAND)).distinct()
    shared = links.groupBy(CAND).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("shared_targets"), F.count("*").alias("matched"))
    known = pool.select(F.col("entity_id").alias(CAND))
    unknown = links.join(known, CAND, "left_anti").agg(F.count("*").alias("unknown_targets"))
    absent = truth.join(refs.select(F.col("entity_id").alias(REF)), REF, "left_anti").agg(F.count("*").alias("unknown_refs"))
    rest = known.join(links.select(CAND).distinct(), CAND, "left_anti").agg(F.count("*").alias("unmatched"))
    return lists.crossJoin(shared).crossJoin(unknown).crossJoin(absent).crossJoin(rest)


def matches_histogram(counts: DataFrame) -> DataFrame:
    return counts.groupBy("n_matches").agg(F.count("*").alias("n"))


def composition(truth: DataFrame) -> DataFrame:
    """(sources, n): which sources the lists draw on."""
    ids = tx.id_list(F.col("matched_entity_ids"))
    two, three = F.exists(ids, lambda x: x.startswith("S2-")), F.exists(ids, lambda x: x.startswith("S3-"))
    kind = F.when(two & three, "S2+S3").when(two, "S2").when(three, "S3").otherwise("none")
    return truth.select(kind.alias("sources")).groupBy("sources").agg(F.count("*").alias("n"))


def by_country(counts: DataFrame, records: DataFrame) -> DataFrame:
    """(country, zero, one, more) over references with n_matches."""
    known = counts.join(records.select(F.col("entity_id").alias(REF), "country"), REF, "left").select(F.coalesce("country", F.lit("UNKNOWN")).alias("country"), "n_matches")
    return known.groupBy("country").agg(F.count_if(F.col("n_matches") == 0).alias("zero"), F.count_if(F.col("n_matches") == 1).alias("one"), F.count_if(F.col("n_matches") >= 2).alias("more"))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("entity_id").intersect(b.select("entity_id")).agg(F.count("*").alias("n_shared"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_null, n_rows), in one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot(["_rows"], columns, "column_name", "n_null").select("column_name", "n_null", F.col("_rows").alias("n_rows"))


def report(title: str, sections: dict[str, DataFrame], most: int = 50) -> str:
    """Markdown of small tables; each shows `most` rows."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = df.limit(most).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows] + [""]
    return "\n".join(out)
