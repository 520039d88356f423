"""Pair features: twelve of text and three of retrieval."""

from __future__ import annotations

import re
from collections import Counter
from math import sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomlink.functions import similarity as sim
from loomlink.operators import checks
from loomlink.schemas import CAND, FEATURES, PAIR, REF, RETRIEVAL

#: Fixed value: the largest vocabulary of a field.
VOCABULARY = 100_000


def join_pairs(pairs: DataFrame, records: DataFrame, check: bool = True) -> DataFrame:
    """pairs with name and address of both sides; raises on bad keys, prefixes or unknown ids if asked to check."""
    if check:
        checks.require(checks.pair_keys(pairs), "pairs")
        checks.require(checks.record_keys(records), "records")
        checks.require(checks.prefixes(pairs), "pairs")
        ids = pairs.select(F.explode(F.array(REF, CAND)).alias("entity_id")).distinct().join(records, "entity_id", "left_anti")
        checks.require(checks.rows(ids, "unknown_id", F.col("entity_id")), "pairs")

    def side(p: str, key: str) -> DataFrame:
        return records.select(F.col("entity_id").alias(key), F.col("name_norm").alias(f"{p}_name"), F.col("address_norm").alias(f"{p}_address"))

    return pairs.join(side("source1", REF), REF, "left").join(side("candidate", CAND), CAND, "left")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def word_idf(corpus: DataFrame, column: str, most: int | None = VOCABULARY) -> DataFrame:
    """(token, idf) of the corpus's words: smoothed, for the `most` words most often used (all, if None); nulls don't count."""
    texts = corpus.where(F.col(column).isNotNull()).select(words(F.col(column)).alias("w"))
    n = texts.agg(F.count("*").alias("n"))
    kept = texts.select(F.explode(F.array_distinct("w")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    if most is not None:
        tf = texts.select(F.explode("w").alias("token")).groupBy("token").agg(F.count("*").alias("tf"))
        kept = tf.join(kept, "token").orderBy(F.desc("tf"), "token").limit(most)
    return kept.crossJoin(F.broadcast(n)).select("token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def training_corpus(records: DataFrame, refs: DataFrame, links: DataFrame) -> DataFrame:
    """Records of the training references and of their true targets."""
    ids = refs.select(F.col(REF).alias("entity_id")).union(links.join(refs, REF, "left_semi").select(CAND)).distinct()
    return records.join(ids, "entity_id", "left_semi")


def word_similarities(joined: DataFrame, idf: DataFrame, field: str) -> DataFrame:
    """(ref, cand, cosine, overlap) of the pairs whose two texts are there; words without idf weigh nothing.

    Each distinct text's words, weights and length are made once, as a map of the few words it has; a pair then needs two
    joins and no rows for its words.
    """
    a, b = F.col(f"source1_{field}"), F.col(f"candidate_{field}")
    there = joined.where(a.isNotNull() & (a != "") & b.isNotNull() & (b != "")).select(*PAIR, a.alias("x"), b.alias("y"))
    texts = there.select(F.explode(F.array("x", "y")).alias("t")).distinct()
    tf = texts.select("t", F.explode(words(F.col("t"))).alias("token")).groupBy("t", "token").agg(F.count("*").alias("tf"))
    w = tf.join(idf, "token").select("t", "token", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    made = w.groupBy("t").agg(
        F.map_from_entries(F.collect_list(F.struct("token", F.struct("w", "idf")))).alias("m"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"),
        F.sum("idf").alias("s"),
    )
    one = lambda k: made.select(F.col("t").alias(k), *[F.col(c).alias(c + k) for c in "mns"])
    both = there.join(one("x"), "x", "left").join(one("y"), "y", "left")
    none, zero = F.array().cast("array<string>"), F.lit(0.0)
    common = F.array_intersect(F.coalesce(F.map_keys("mx"), none), F.coalesce(F.map_keys("my"), none))
    dot = F.aggregate(common, zero, lambda t, k: t + F.col("mx")[k]["w"] * F.col("my")[k]["w"])
    shared = F.aggregate(common, zero, lambda t, k: t + F.col("mx")[k]["idf"])
    both = both.select(*PAIR, dot.alias("dot"), shared.alias("shared"), F.coalesce(F.col("nx") * F.col("ny"), zero).alias("scale"), (F.coalesce("sx", zero) + F.coalesce("sy", zero)).alias("sum"))
    whole = F.col("sum") - F.col("shared")
    return both.select(
        *PAIR,
        F.when(F.col("scale") > 0, F.least(F.greatest(F.col("dot") / F.col("scale"), zero), F.lit(1.0))).otherwise(0.0).alias("cosine"),
        F.when(whole > 0, F.col("shared") / whole).otherwise(0.0).alias("overlap"),
    )


def _weighed(text: str, idf: dict[str, float]) -> tuple[dict[str, tuple[float, float]], float, float]:
    """A text's words with weight and idf, the length of the weights, and the sum of idf."""
    tf = Counter(t for t in re.split(r"[ \t\n\x0b\f\r]+", text) if t in idf)
    m = {t: (n * idf[t], idf[t]) for t, n in tf.items()}
    return m, sqrt(sum(w * w for w, _ in m.values())), sum(x for _, x in m.values())


def pair_words(a: Column, b: Column, idf: DataFrame) -> Column:
    """(cosine, overlap) of two texts as in word_similarities, without joins: the table of words is broadcast, so it
    must be bounded, as that of a FeatureExtractor is."""
    shared = idf.sparkSession.sparkContext.broadcast({r["token"]: r["idf"] for r in idf.toLocalIterator()})

    @F.pandas_udf("cosine double, overlap double")
    def both(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        known: dict[str, tuple] = {"": ({}, 0.0, 0.0)}
        out = []
        for one, other in zip(x, y, strict=True):
            if not one or not other:
                out.append((None, None))
                continue
            for text in (one, other):
                if text not in known:
                    known[text] = _weighed(text, shared.value)
            (m, n, s), (m2, n2, s2) = known[one], known[other]
            common = [t for t in m if t in m2]
            dot, part = sum(m[t][0] * m2[t][0] for t in common), sum(m[t][1] for t in common)
            out.append((min(max(dot / (n * n2), 0.0), 1.0) if n * n2 > 0 else 0.0, part / (s + s2 - part) if s + s2 - part > 0 else 0.0))
        return pd.DataFrame(out, columns=["cosine", "overlap"], dtype="float64")

    return both(a, b)


class FeatureExtractor:
    """Word weights of names and addresses, fitted once; transform never refits."""

    def __init__(self, vocabulary: int = VOCABULARY):
        self.vocabulary, self.idf = vocabulary, None

    def fit(self, corpus: DataFrame) -> FeatureExtractor:
        self.idf = {f: word_idf(corpus, f"{f}_norm", self.vocabulary) for f in ("name", "address")}
        return self

    def save(self, path: str) -> None:
        for f, table in self._fitted().items():
            table.write.mode("error").parquet(f"{path}/{f}")

    @classmethod
    def load(cls, spark, path: str) -> FeatureExtractor:
        made = cls()
        made.idf = {f: spark.read.parquet(f"{path}/{f}") for f in ("name", "address")}
        return made

    def _fitted(self) -> dict[str, DataFrame]:
        if self.idf is None:
            raise ValueError("the extractor is not fitted")
        return self.idf

    def transform(self, joined: DataFrame, kind: str = "float") -> DataFrame:
        """Pair ids and the twelve features, in order; NULL where a side is missing."""
        idf, out = self._fitted(), joined
        for f in ("name", "address"):
            a, b = F.col(f"source1_{f}"), F.col(f"candidate_{f}")
            gone = {p: c.isNull() | (c == "") for p, c in (("source1", a), ("candidate", b))}
            there = ~gone["source1"] & ~gone["candidate"]
            out = out.withColumns({f"{p}_{f}_missing": g.cast("double") for p, g in gone.items()})
            out = out.withColumn(f"{f}_jaro_winkler", F.when(there, sim.jaro_winkler(a, b))).withColumn(f"{f}_token_sort", F.when(there, sim.token_sort(a, b)))
            out = out.withColumn("_both", pair_words(a, b, idf[f]))
            out = out.withColumns({f"{f}_tfidf_cosine": F.col("_both.cosine"), f"{f}_idf_overlap": F.col("_both.overlap")}).drop("_both")
        return out.select(*PAIR, *[F.col(c).cast(kind).alias(c) for c in FEATURES])


def add_retrieval_features(pairs: DataFrame, check: bool = True) -> DataFrame:
    """pairs (ref, cand, score as text or number) with blocking_score, candidate_rank and blocking_top1_top2_gap."""
    pairs = pairs.withColumn("score", F.col("score").cast("double"))
    if check:
        checks.require(checks.prefixes(pairs), "pairs")
        checks.require(checks.pair_keys(pairs), "pairs")
        checks.require(checks.scores(pairs), "pairs")
    order = W.partitionBy(REF).orderBy(F.desc("score"), CAND)
    ranked = pairs.withColumn("candidate_rank", F.row_number().over(order))
    first = lambda k: F.max(F.when(F.col("candidate_rank") == k, F.col("score"))).over(W.partitionBy(REF))
    ranked = ranked.withColumn("blocking_score", F.col("score")).withColumn("blocking_top1_top2_gap", first(1) - first(2))
    rest = [c for c in pairs.columns if c not in (*PAIR, "score")]
    return ranked.select(*PAIR, *rest, *RETRIEVAL)
