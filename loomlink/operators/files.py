"""Format rules of result files: `ref<tab>id,id,...` under a header, one row for each reference.

Findings are rows (file, severity, rule, entity). An error makes a file unfit, a warning doesn't. A file that is absent,
empty or under a wrong header has that one finding. Lines without a tab are reported unless blank; of several rows of a
reference the last one counts for the comparison of files. Nulls among required or known ids are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomlink.schemas import REF
from loomlink.sources import io

#: Column names of the two files.
HEADERS = {"matching": [REF, "matched_entity_ids"], "candidates": [REF, "candidate_entity_ids"]}
FINDING = "file string, severity string, rule string, entity string"


def findings(df: DataFrame, file: str, rule: str, entity: Column, severity: str = "error") -> DataFrame:
    return df.select(F.lit(file).alias("file"), F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), entity.cast("string").alias("entity"))


def header_fault(header: str, file: str) -> str | None:
    """The rule that a header line breaks."""
    if "\t" not in header and "," in header:
        return "comma_separated"
    return None if [c.strip().lower() for c in header.split("\t")] == HEADERS[file] else "wrong_header"


def parsed(lines: DataFrame) -> DataFrame:
    """Lines (at, value) as (at, value, ref, ids); ref is null without a tab, ids are empty for a blank list."""
    tab = F.instr("value", "\t")
    rest = F.substr("value", tab + 1)
    ids = F.when(F.trim(F.regexp_replace(rest, r"\s", " ")) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.select("at", "value", F.when(tab > 0, F.substr("value", F.lit(1), tab - 1)).alias("ref"), F.when(tab > 0, ids).alias("ids"))


def row_findings(rows: DataFrame, file: str, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Errors of parsed rows; required and known hold entity_id."""
    good = rows.where("ref IS NOT NULL")
    # ids that break a rule are few: only they are made distinct
    odd = good.select(F.explode("ids").alias("id"))
    seen = good.groupBy("ref").agg(F.count("*").alias("n"), F.max((F.size("ids") > F.size(F.array_distinct("ids"))).cast("int")).alias("repeats"))
    met = seen.join(required.select(F.col("entity_id").alias("want")).where("want IS NOT NULL").distinct(), F.col("ref") == F.col("want"), "full")
    told = F.filter(
        F.array(
            F.when(F.col("n") > 1, "repeated_row"),
            F.when(F.col("repeats") > 0, "repeated_id"),
            F.when(F.col("ref").isNull(), "missing_reference"),
            F.when(F.col("want").isNull(), "unknown_reference"),
        ),
        lambda x: x.isNotNull(),
    )
    of_rows = met.select(F.coalesce("ref", "want").alias("entity"), F.explode(told).alias("rule"))
    parts = [
        findings(rows.where(F.col("ref").isNull() & (F.trim("value") != "")), file, "no_tab", F.col("value")),
        of_rows.select(F.lit(file).alias("file"), F.lit("error").alias("severity"), "rule", "entity"),
        findings(odd.where("id LIKE 'S1-%'").distinct(), file, "self_match", F.col("id")),
        findings(odd.where("NOT id RLIKE '^S[123]-'").distinct(), file, "wrong_prefix", F.col("id")),
    ]
    if known is not None:
        unknown = odd.where("id RLIKE '^S[23]-'").join(known.select(F.col("entity_id").alias("id")), "id", "left_anti").distinct()
        parts.append(findings(unknown, file, "unknown_id", F.col("id")))
    return reduce(DataFrame.unionByName, parts)


def outside(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Warnings for references with a match that their candidates lack, by the last row of each."""
    last = lambda rows, name: rows.where("ref IS NOT NULL").groupBy("ref").agg(F.max_by("ids", "at").alias(name))
    both = last(matching, "ids").join(last(candidates, "of"), "ref", "left")
    lacking = F.size(F.array_except("ids", F.coalesce("of", F.array().cast("array<string>")))) > 0
    return findings(both.where(lacking), "matching", "not_a_candidate", F.col("ref"), "warning")


def summary(found: DataFrame, examples: int = 5) -> DataFrame:
    """(file, severity, rule, n, examples): the number of findings of each rule and its smallest entities."""
    keys = ["file", "severity", "rule"]
    first = found.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy("entity"))).where(F.col("_place") <= examples)
    shown = first.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("entity")), ", ").alias("examples"))
    return found.groupBy(*keys).agg(F.count("*").alias("n")).join(shown, keys)


def read_lines(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """(distinct headers, two at most; the other lines as (at, value)) of a file, or of a folder's parts with a header each.

    The first line of a part is found among the lines of its first block, so no task sees more than one block of a file.
    """
    place = F.struct(F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", place.alias("at"))
    begin = lines.where("at.start = 0").withColumn("_n", F.row_number().over(W.partitionBy("at.part").orderBy("at.line")))
    headers = [r["value"] for r in begin.where("_n = 1").select("value").distinct().limit(2).collect()]
    return headers, begin.where("_n > 1").drop("_n").unionByName(lines.where("at.start > 0"))


def validate_files(spark: SparkSession, matching: str, candidates: str | None, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Findings on the files at these paths. The matching file must be there; without candidates, or without known ids to
    compare with, a warning says what wasn't checked."""
    parts, read = [], {}
    say = lambda file, severity, rule: parts.append(spark.createDataFrame([(file, severity, rule, None)], FINDING))
    if known is None:
        say("matching", "warning", "ids_unchecked")
    for file, path in (("matching", matching), ("candidates", candidates)):
        if path is None or not io.exists(spark, path):
            say(file, "error" if file == "matching" else "warning", "file_not_found")
            continue
        headers, lines = read_lines(spark, path)
        fault = "empty_file" if not headers else next(filter(None, (header_fault(h, file) for h in headers)), None)
        if fault:
            say(file, "error", fault)
            continue
        read[file] = parsed(lines)
        parts.append(row_findings(read[file], file, required, known))
    if len(read) == 2:
        parts.append(outside(read["matching"], read["candidates"]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], FINDING)
