"""A corpus from raw documents to packed training sequences, in five stages that each write and read Parquet.

1. quality_rules: documents that the rules reject go.
2. ngram_jaccard_join: of each group of near duplicates the document of the smallest doc_id stays. Rows of one doc_id
   with different texts are documents of their own; rows of equal doc_id and text are one, and stay or go together.
3. suffix_array_dedup: bytes of repeated strings go; a document goes that has none left.
4. personal_data: spans of personal data are replaced by their kind.
5. best_fit_packing: the texts become pieces placed in sequences.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs, whatever
their names, of which n_chars follows the text where there is one.

Defined results of every stage: a null text counts as empty, and an empty text has too few words for stage 1, so neither
goes further. Documents without a doc_id pass stages 2 and 3 unchanged. Repeated rows are judged alike in stage 1, stay
or go together in stage 2, lose and are masked alike in stages 3 and 4, and are packed each. Of near duplicates with one
smallest doc_id and several texts, the row of the least hash stays. Texts of any length are taken whole. An empty table
gives an empty one. What a stage stored is removed when the next stage's table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlink.llm import ngram_join, packing, pii, quality_rules, suffix_dedup
from loomlink.llm.common import documents, stored, tables, tidy
from loomlink.llm.quality_rules import quoted


def _whole(docs: DataFrame):
    """All columns as one, which no other name can clash with."""
    return F.struct(*map(quoted, docs.columns)).alias("_kept")


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    kind = dict(docs.dtypes).get("n_chars")
    if kind:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(kind))
    return docs.select(*map(quoted, columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.judge(docs, docs.columns).where("_q.kept").select("_kept.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))  # tells apart texts of one doc_id
    told = stored(ngram_join.join(docs.select(row.alias("doc_id"), "text")).where("doc_id is not null"), "near")
    told = told.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    known = stored(docs.where("doc_id is not null").select("doc_id", row.alias("_row")).distinct().join(told, "_row"), "rows")
    first = known.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("first"))
    gone = stored(known.join(first, "component_id").where("_row <> first").select("_row"), "gone")
    return docs.select(_whole(docs), row.alias("_row")).join(gone, "_row", "left_anti").select("_kept.*")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    slim = docs.select("doc_id", "text", F.struct(*map(quoted, rest)).alias("rest")) if rest else docs
    cut = suffix_dedup.dedup(slim, keep_text=True).where("n_removed = 0 or n_removed < n_bytes")
    cut = cut.select("doc_id", F.col("kept_text").alias("text"), *(["rest.*"] if rest else []))
    return _recounted(cut, docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(pii.redact(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("personal_data", personal_data),
    ("best_fit_packing", packed),
]
#: No SQL expresses exact substring removal or BPE in reasonable time; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), tables(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        tidy(spark, before, docs)
    return docs
