"""Hand-computed cases of the linkage engine."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomlink.functions import similarity as sim
from loomlink.functions import text as tx
from loomlink.operators import blocking, boosting, checks, decision, evaluate, features, files, model
from loomlink.plans import catalog, linkage
from loomlink.schemas import CAND, FEATURES, PAIR, REF, SCORED_FEATURES
from loomlink.sources import config, io, testdata


def pairs(spark, rows, more="score double"):
    return spark.createDataFrame(rows, f"{REF} string, {CAND} string, {more}")


@pytest.mark.parametrize(
    "raw,name,suffix",
    [
        ("Café Ltd.", "cafe", "ltd"),
        ("Nan Inc.", "nan", "inc"),
        ("  N/A ", None, None),
        ("McDonald's & Co", "mcdonalds and", "co"),
        ("A.B.C. L.L.C.", "abc", "llc"),
        ("X Private Limited", "x", "pvt ltd"),
        ("X Private", "x private", None),
        ("Ltd", "ltd", None),
        ("Co Ltd", "co", "ltd"),
        ("!!!", None, None),
        ("PrÃ©sident", "president", None),
        (" \\N", None, None),
        ("1.5 Straße", "15 strasse", None),
    ],
)
def test_names(spark, raw, name, suffix):
    for some in (False, True):
        df = spark.createDataFrame([("S1-1", raw, "", " US ")], "entity_id string, business_name string, business_address string, country string")
        got = tx.normalize_records(df, any_script=some).first()
        assert (got["name_norm"], got["legal_suffix"], got["address_norm"], got["country"]) == (name, suffix, None, "US")


def test_repair_by_runs(spark):
    cases = {"Ã©t é Ã©": "ét é é", "日 Ã©t": "日 ét", "plain": "plain", None: None, "日 â\u0082¬ Ãx": "日 € Ãx", "é ð\u009f\u0098\u0080©": "é 😀©"}
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", tx.repair(F.col("x")).alias("y"), tx.normalize_text(F.col("x")).alias("z"))
    got = {r["x"]: r for r in df.collect()}
    assert {k: r["y"] for k, r in got.items()} == cases and got["Ã©t é Ã©"]["z"] == "et e e"


def test_ungrouped_across_empty_slices(spark):
    lines = lambda rows: spark.createDataFrame(rows, f"{REF} string, line_no long")
    assert checks.ungrouped(lines([("a", 0), ("a", 5_000_000), ("b", 5_000_001)])).count() == 0
    found = checks.ungrouped(lines([("a", 0), ("b", 999_999), ("b", 3_000_000), ("a", 9_000_000), ("a", 12_000_000)])).collect()
    assert [(r["ref"], r["detail"]) for r in found] == [("a", "2")]


def test_sweep_as_one_decision_for_each_threshold(spark):
    import random

    rng = random.Random(3)
    rows = sorted({(f"S1-{rng.randrange(12)}", f"S2-{rng.randrange(25)}"): rng.choice([0.02, 0.3, 0.31, 0.5, 0.977, None, float("nan"), rng.random()]) for _ in range(160)}.items())
    pairs_ = spark.createDataFrame([(*k, p) for k, p in rows], f"{REF} string, {CAND} string, probability double")
    truth = spark.createDataFrame([(f"S1-{k}", [f"S2-{j}" for j in range(k % 4)]) for k in range(12)], "ref string, ids array<string>")
    grid = decision.grid(spark)
    fast = {r["threshold"]: r["macro_f"] for r in decision.sweep(pairs_, truth, grid).collect()}
    plain = {r["threshold"]: r["macro_f"] for r in decision.sweep(pairs_, truth, grid, lambda p: decision.assign(p, "threshold")).collect()}
    assert fast.keys() == plain.keys() and all(fast[t] == pytest.approx(plain[t], abs=1e-12) for t in plain)


@pytest.mark.parametrize("block,asking,turn", [(4096, 512, 16), (3, 2, 1)])
def test_candidates_against_all_scored_pairs(spark, monkeypatch, block, asking, turn):
    """Top-K of blocks, with bounds and turns, as the best of all pairs' scores; ties, empty fields and equal records."""
    import random

    for name, value in (("BLOCK", block), ("ASKING", asking), ("TURN", turn)):
        monkeypatch.setattr(blocking, name, value)
    rng = random.Random(4)
    words = "red blue green old new tall x main road 12 7".split()
    text = lambda n: " ".join(rng.choices(words, k=n)) or None
    rows = [(f"S{s}-{k}", text(rng.randrange(4)), text(rng.randrange(4))) for s in (1, 2) for k in range(20)]
    rows += [(f"S2-{100 + k}", "red blue", "12 main road") for k in range(8)] + [("S1-99", None, None), ("S1-98", "red blue", "7 new road")]
    df = spark.createDataFrame(rows, "entity_id string, name_norm string, address_norm string")
    s1, pool = df.where("entity_id like 'S1%'"), df.where("entity_id like 'S2%'")
    want = blocking.top_k(blocking.score_pairs(s1, pool).withColumn("score", F.round("score", 6)), 5)
    got = blocking.retrieve_candidates(s1, pool, 5, digits=6)
    assert sorted(map(tuple, got.select(*PAIR, "score", "rank").collect())) == sorted(map(tuple, want.select(*PAIR, "score", "rank").collect()))


@pytest.mark.parametrize("wide,chunk,turn,width,digits", [(3, 2, 1, (1, 2), 6), (9, 5, 2, (4, 300), 6), (32768, 8192, 16, (128, 256), None)])
def test_search_in_parts_finds_the_best_of_all(spark, monkeypatch, wide, chunk, turn, width, digits):
    """Dense columns and lists of any share, blocks, chunks and turns; letters of any script, and words without a gram."""
    for name, value in (("WIDE", wide), ("CHUNK", chunk), ("TURN", turn)):
        monkeypatch.setattr(blocking, name, value)
    monkeypatch.setattr(blocking.search, "WIDTH", width)
    rng = random.Random(5)
    words = "red blue greenish x 12 7 дом été 😀 new".split()
    text = lambda: " ".join(rng.choices(words, k=rng.randrange(4))) or None
    rows = [(f"S{s}-{k}", text(), text()) for s in (1, 2) for k in range(24)] + [("S1-90", "x", None), ("S2-90", None, "x"), ("S2-91", "x", "x"), ("S1-91", "zzz", "qqq")]
    df = spark.createDataFrame(rows, "entity_id string, name_norm string, address_norm string")
    s1, pool = df.where("entity_id like 'S1%'"), df.where("entity_id like 'S2%'")
    plain = blocking.score_pairs(s1, pool).withColumn("score", F.round("score", 6))
    got = blocking.retrieve_candidates(s1, pool, 6, digits=digits).withColumn("score", F.round("score", 6))
    full = {(r[REF], r[CAND]): r["score"] for r in plain.collect()}
    rows = [tuple(r) for r in got.select(*PAIR, "score", "rank").collect()]
    assert all(full[a, b] == x for a, b, x, _ in rows)
    if digits:
        assert sorted(rows) == sorted(map(tuple, blocking.top_k(plain, 6).select(*PAIR, "score", "rank").collect()))
    for ref in {a for a, _ in full}:
        assert sorted(x for a, _, x, _ in rows if a == ref) == sorted((x for (a, _), x in full.items() if a == ref), reverse=True)[:6][::-1]


def test_search_makes_no_row_for_a_block(spark, monkeypatch):
    """A reference has its k rows once for a turn, however many tasks and blocks there are."""
    monkeypatch.setattr(blocking, "WIDE", 5)
    held, stored = [], blocking.kept
    monkeypatch.setattr(blocking, "kept", lambda df: held.append(stored(df)) or held[-1])
    monkeypatch.setattr(blocking, "drop", lambda *_: None)
    text = lambda k: f"shop {k % 7} of {k}"
    made = lambda s, n: spark.createDataFrame([(f"S{s}-{k}", text(k), f"{k} road") for k in range(n)], "entity_id string, name_norm string, address_norm string")
    blocking.retrieve_candidates(made(1, 10), made(2, 60), 4, digits=6)
    assert [df.count() for df in held if "score" in df.columns] == [40]


def test_copies_are_searched_for_once(spark, monkeypatch):
    """Equal records are one class in the search, and each still has its rows, by place in the pool among equals."""
    held, stored = [], blocking.kept
    monkeypatch.setattr(blocking, "kept", lambda df: held.append(stored(df)) or held[-1])
    texts = [("red blue", "12 main road"), ("old green x", None), ("red", "7 new road")]
    rows = lambda s, copies: [(f"S{s}-{k * copies + c}", *t) for k, t in enumerate(texts) for c in range(copies)]
    made = lambda r: spark.createDataFrame(r, "entity_id string, name_norm string, address_norm string")
    s1, pool = made(rows(1, 4)), made(rows(2, 30))
    plain = blocking.score_pairs(s1, pool).withColumn("score", F.round("score", 6))
    place = -F.substr(F.col(CAND), F.lit(4)).cast("long")
    want = blocking.top_k(plain.withColumn("pool_pos", place), 7, "pool_pos").select(*PAIR, "score", "rank")
    got = blocking.retrieve_candidates(s1, pool.withColumn("pool_pos", -F.substr("entity_id", F.lit(4)).cast("long")), 7, digits=6)
    assert sorted(map(tuple, got.select(*PAIR, "score", "rank").collect())) == sorted(map(tuple, want.collect()))
    refs = next(df for df in held[1:] if "members" in df.columns)
    assert refs.count() == len(texts) and refs.agg(F.sum(F.size("members"))).first()[0] == 12


def test_similarities_of_many_pairs_at_once():
    """The same numbers as one by one, bit for bit; only texts that are empty or have over 64 characters go one by one."""
    rng, alone = random.Random(2), []
    for letters, most in (("ab", 9), ("abc é", 30), ("abcdef gh", 80), ("дx😀 ", 12)):
        text = lambda: "".join(rng.choices(letters, k=rng.randrange(most)))  # noqa: B023, E731
        x, y = [*(text() for _ in range(3000)), None, "a", "a" * 64, "ab" * 32], [*(text() for _ in range(3000)), "a", None, "a" * 64, "ba" * 32]
        for one, many, prepared in ((sim.jaro_winkler_of, sim._jaro_winkler_all, None), (sim.token_sort_of, sim._token_sort_all, sim._sorted_words)):
            noted = lambda s, t: alone.append((s, t)) or one(s, t)  # noqa: B023, E731
            got = sim._pairwise(pd.Series(x), pd.Series(y), noted, many, prepared).tolist()
            assert all(g == one(s, t) if s is not None and t is not None else g != g for g, s, t in zip(got, x, y, strict=True))
    assert alone and all(not s or not t or len(s) > 64 or len(t) > 64 for s, t in alone)


def test_features_need_no_join_for_words(spark):
    """The same similarities as by joins, to a float's digits, and no rows dealt out."""
    rng = random.Random(9)
    text = lambda: rng.choice([None, "", "zz", " ".join(rng.choices("red blue green old new tall".split(), k=rng.randrange(1, 5))), "red\tred  blue"])
    rows = [(f"S1-{k}", f"S2-{k}", text(), text(), text(), text()) for k in range(200)]
    joined = spark.createDataFrame(rows, f"{REF} string, {CAND} string, source1_name string, source1_address string, candidate_name string, candidate_address string")
    corpus = spark.createDataFrame([("red blue blue", "red old"), ("green blue", "new"), ("tall", None)], "name_norm string, address_norm string")
    fitted = features.FeatureExtractor().fit(corpus)
    made = fitted.transform(joined, "double")
    got = {r[REF]: r for r in made.collect()}
    for f in ("name", "address"):
        want = {r[REF]: r for r in features.word_similarities(joined, fitted.idf[f], f).collect()}
        assert want and len(got) == 200
        for key, r in got.items():
            for c, name in (("tfidf_cosine", "cosine"), ("idf_overlap", "overlap")):
                assert r[f"{f}_{c}"] == (pytest.approx(want[key][name], abs=1e-12) if key in want else None)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_cosines_of_linked_pairs_only(spark, monkeypatch):
    """As the cosines of all pairs, cut to the links; the query doesn't make all pairs."""
    from loomlink.sources import testdata

    rng = random.Random(5)
    text = lambda: rng.choice([None, "a", " ".join(rng.choice(["rare", "shop", "main", "ab"]) for _ in range(3))])
    records = lambda n, s: spark.createDataFrame([(f"S{s}-{k}", text(), text()) for k in range(n)], "entity_id string, name_norm string, address_norm string")
    left, right, _ = blocking.vectors(records(12, 1), records(20, 2))
    links = pairs(spark, [(f"S1-{rng.randrange(12)}", f"S2-{k}", 1.0) for k in range(20)]).select(*PAIR)
    row = lambda r: (r[REF], r[CAND], r["field"], round(r["cosine"], 9))
    want = sorted(map(row, blocking.pair_cosines(left, right).join(links, PAIR, "left_semi").collect()))
    assert want and sorted(map(row, blocking.linked_cosines(links, left, right).collect())) == want
    monkeypatch.setattr(blocking, "pair_cosines", lambda *a: pytest.fail("all pairs"))
    assert testdata.links(spark, "/root/testdata/sf0.001").count() <= catalog.queries()["jn10_pair_cosines"](spark, "/root/testdata/sf0.001").count()


def test_idf_of_every_word(spark, tmp_path):
    """Over 100,000 words in names: agg01 and sim03's weights have all, agg02 the cap that its SQL has."""
    n = features.VOCABULARY // 4 + 100
    word = lambda k: F.concat(F.lit("w"), (F.col("doc_id") * 4 + k).cast("string"))
    docs = spark.range(n).select(F.col("id").alias("doc_id")).select("doc_id", F.concat_ws(" ", *map(word, range(4)), F.lit("street")).alias("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    folder = str(tmp_path)
    assert catalog.queries()["agg01_word_idf"](spark, folder).count() == 4 * n
    assert catalog.queries()["agg02_vocabulary_cap"](spark, folder).count() == features.VOCABULARY


def test_similarities():
    assert round(sim.jaro_winkler_of("abxyzq", "abmnop"), 4) == 0.5556
    assert round(sim.jaro_winkler_of("acme shop", "acme shops"), 2) == 0.98
    assert sim.token_sort_of("b a", "a b") == 1.0
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(9))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert sim.common_subsequence(a, b) == t[-1][-1]


def records(spark):
    return spark.createDataFrame([("S1-1", "rare shop", "12 main road"), ("S2-1", "rare shop", "12 main road"), ("S3-1", "common store", None)], "entity_id string, name_norm string, address_norm string")


def test_features(spark):
    rec = records(spark)
    joined = features.join_pairs(pairs(spark, [("S1-1", "S2-1", 1.0), ("S1-1", "S3-1", 0.5)]), rec)
    out = {r[CAND]: r for r in features.FeatureExtractor().fit(rec).transform(joined).collect()}
    assert out["S2-1"].__fields__ == [*PAIR, *FEATURES]
    assert out["S2-1"]["name_jaro_winkler"] == out["S2-1"]["address_tfidf_cosine"] == out["S2-1"]["name_idf_overlap"] == 1
    assert out["S3-1"]["address_token_sort"] is None and out["S3-1"]["candidate_address_missing"] == 1 and out["S3-1"]["name_tfidf_cosine"] == 0
    with pytest.raises(ValueError, match="not fitted"):
        features.FeatureExtractor().transform(joined)
    assert features.FeatureExtractor().fit(rec).transform(joined.limit(0)).columns == [*PAIR, *FEATURES]


@pytest.mark.parametrize("rows,word", [([("S1-1", "S2-9")], "unknown_id"), ([("S1-1", "S2-1")] * 2, "repeated"), ([("S1-1", "S1-1")], "prefix")])
def test_bad_pairs(spark, rows, word):
    with pytest.raises(ValueError, match=word):
        features.join_pairs(pairs(spark, [(*r, 1.0) for r in rows]), records(spark))


def test_retrieval_features(spark):
    rows = [("S1-a", "S3-z", "0.9"), ("S1-b", "S2-b", "0.4"), ("S1-a", "S2-a", "0.9"), ("S1-a", "S2-c", "0.2")]
    got = {r[CAND]: (r["candidate_rank"], r["blocking_top1_top2_gap"]) for r in features.add_retrieval_features(pairs(spark, rows, "score string")).collect()}
    assert got == {"S3-z": (2, 0), "S2-b": (1, None), "S2-a": (1, 0), "S2-c": (3, 0)}
    rows = [("S1-a", "S2-a", "0.30000000000000004"), ("S1-a", "S2-b", "0.3")]
    assert features.add_retrieval_features(pairs(spark, rows, "score string")).where("candidate_rank = 1").first()[CAND] == "S2-a"
    for bad in ("nan", "inf", "-1", "9", "x"):
        with pytest.raises(ValueError, match="score"):
            features.add_retrieval_features(pairs(spark, [("S1-a", "S2-a", bad)], "score string").withColumn("score", F.expr("try_cast(score as double)")))


def test_blocking_metrics(spark):
    refs = spark.createDataFrame([("S1-a",), ("S1-b",), ("S1-c",)], f"{REF} string")
    links = spark.createDataFrame([("S1-a", "S2-a"), ("S1-a", "S3-z"), ("S1-c", "S3-x")], f"{REF} string, {CAND} string")
    got = evaluate.blocking_metrics(pairs(spark, [("S1-a", "S3-z", 1.0), ("S1-b", "S2-b", 1.0), ("S1-a", "S2-a", 1.0)]), links, refs).first()
    assert (got["n_links"], got["n_found"], got["macro_recall"], got["n_without_candidates"]) == (3, 2, 0.5, 1)
    assert evaluate.blocking_recall(pairs(spark, []), links, refs).first()["recall"] == 0


def frame(spark, rows):
    full = [(r, c, p, 0.5, 0.9, 0.0, 0.0, "US", "US") for r, c, p in rows]
    return pairs(spark, full, "probability double, address_tfidf_cosine double, address_token_sort double, source1_address_missing double, candidate_address_missing double, source1_country string, candidate_country string")


def kept(df):
    return sorted((r[REF], r[CAND]) for r in df.collect())


def test_decisions(spark):
    assert kept(decision.decide(frame(spark, [("a", "x", 0.91), ("b", "x", 0.97), ("a", "y", 0.95)]), 0.5)) == [("a", "y"), ("b", "x")]
    assert kept(decision.decide(frame(spark, [("z", "x", 0.9), ("a", "x", 0.9)]), 0.5)) == [("a", "x")]
    assert kept(decision.decide(frame(spark, [("a", "x", 0.5), ("b", "y", float("nan"))]), 0.5)) == [("a", "x")]
    rule, one = decision.Corroboration(), frame(spark, [("a", "x", 0.99)])
    low = one.withColumn("address_tfidf_cosine", F.lit(0.02))
    assert kept(decision.corroborated(low.withColumn("address_token_sort", F.lit(0.3)), rule)) == []
    assert kept(decision.corroborated(low, rule)) == [("a", "x")]
    gone = one.withColumn("address_tfidf_cosine", F.lit(None).cast("double"))
    assert kept(decision.corroborated(gone, rule)) == [("a", "x")] and kept(decision.corroborated(gone.withColumn("probability", F.lit(0.7)), rule)) == []
    for country, stays in (("France", False), (None, True), ("", True), (" us ", True)):
        assert bool(kept(decision.country_veto(one.withColumn("candidate_country", F.lit(country).cast("string"))))) == stays


def test_guards_only_take_away(spark):
    rng = random.Random(4)
    rows = [(f"S1-{rng.randrange(300)}", f"S2-{rng.randrange(400)}", rng.random(), rng.random(), rng.random(), float(rng.random() < 0.1), 0.0, rng.choice(["US", "India", None]), rng.choice(["US", "India", "France"])) for _ in range(3000)]
    df = pairs(spark, rows, "probability double, address_tfidf_cosine double, address_token_sort double, source1_address_missing double, candidate_address_missing double, source1_country string, candidate_country string").dropDuplicates(PAIR)
    free, guarded = decision.decide(df, 0.4, veto=False), decision.decide(df, 0.4, decision.Corroboration())
    assert set(kept(guarded)) <= set(kept(free))
    assert len({c for _, c in kept(free)}) == free.count() and free.where("probability < 0.4").count() == 0


@pytest.mark.parametrize("p,t,f", [([], [], 1), (["x"], [], 0), (["a", "b", "z"], ["a", "b", "c", "d"], 0.625), (["a"], ["a"], 1), ([], ["a"], 0), (["z"], ["a"], 0), (["a"], ["a", "b"], 5 / 6), (["a", "b", "y", "z"], ["a", "b"], 5 / 9)])
def test_reference_score(spark, p, t, f):
    one = lambda x: spark.createDataFrame([("S1-1", x)], "ref string, ids array<string>")
    assert decision.score(one(p), one(t)) == pytest.approx(f)


def test_sweep_and_best(spark):
    df = frame(spark, [("a", "x", 0.9), ("b", "y", 0.4), ("a", "z", 0.4)])
    truth = spark.createDataFrame([("a", ["x"]), ("b", [])], "ref string, ids array<string>")
    got = {r["threshold"]: r["macro_f"] for r in decision.sweep(df, truth, decision.grid(spark)).collect()}
    assert len(got) == 97 and got[0.3] == pytest.approx((5 / 9 + 0) / 2) and got[0.5] == 1
    assert decision.best_threshold(decision.sweep(df, truth, decision.grid(spark))).first()["threshold"] == 0.9
    with pytest.raises(ValueError):
        decision.score(truth, truth.limit(0))


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "s.tsv").write_bytes("﻿entity_id\tbusiness_name\tbusiness_address\tcountry\r\nS1-1\t\"q\t\tUS\r\nS1-2\tnan\tx\t\n".encode())
    got = [tuple(r) for r in io.read_tsv(spark, str(tmp_path / "s.tsv")).collect()]
    assert got == [("S1-1", '"q', "", "US"), ("S1-2", "nan", "x", "")] and io.count_rows(spark, str(tmp_path / "s.tsv")) == 2
    (tmp_path / "bad.tsv").write_text("a\tb\n")
    with pytest.raises(ValueError, match="header"):
        io.read_tsv(spark, str(tmp_path / "bad.tsv"))
    df = pairs(spark, [("S1-1", "S2-1", 0.5), ("S1-1", "S2-2", 0.9)])
    io.write_tsv(io.id_lists(df, spark.createDataFrame([("S1-1",), ("S1-2",)], f"{REF} string")), str(tmp_path / "out"))
    lines = sorted(line for f in (tmp_path / "out").glob("part-*") for line in f.read_text().splitlines() if not line.startswith("source1"))
    assert lines == ["S1-1\tS2-2,S2-1", "S1-2\t"]
    with pytest.raises(Exception, match="(?i)exist"):
        io.write_tsv(df, str(tmp_path / "out"))
    (tmp_path / "ids.txt").write_text("a\r\n\n b \na\n")
    assert sorted(r[0] for r in io.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    assert io.content_hash(df) == io.content_hash(df.orderBy(CAND)) != io.content_hash(df.limit(1))
    (tmp_path / "paths.example.yaml").write_text("dataset: data  # here\n")
    with pytest.warns(UserWarning):
        paths = config.load_paths(tmp_path)
    assert config.dataset_dir(paths, "dataset", "/r").as_posix() == "/r/data"


def test_matcher(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for r in range(60):
        for c in range(10):
            y = int(rng.random() < 0.15)
            x = {k: rng.random() for k in SCORED_FEATURES} | {"name_tfidf_cosine": min(max(0.3 + 0.6 * y + rng.gauss(0, 0.1), 0.0), 1.0)}
            rows.append((f"S1-{r}", f"S2-{c}", y, *(None if k == "address_tfidf_cosine" and rng.random() < 0.05 else x[k] for k in SCORED_FEATURES)))
    df = pairs(spark, rows, "label int, " + ", ".join(f"{k} double" for k in SCORED_FEATURES))
    fitted = model.train_matcher(df, n_folds=2, trees=4)
    got = fitted.predict(df).groupBy("label").agg(F.avg("probability").alias("p"), F.min("probability").alias("a"), F.max("probability").alias("b")).collect()
    by = {r["label"]: r for r in got}
    assert by[1]["p"] > 0.8 and by[0]["p"] < 0.2 and all(0 <= r["a"] <= r["b"] <= 1 for r in got)
    fitted.save(str(tmp_path / "m"))
    again = model.Matcher.load(str(tmp_path / "m"), SCORED_FEATURES).predict(df.select(*reversed(df.columns)))
    assert again.agg(F.sum("probability")).first()[0] == pytest.approx(fitted.predict(df).agg(F.sum("probability")).first()[0])
    with pytest.raises(ValueError, match="other features"):
        model.Matcher.load(str(tmp_path / "m"), ["x"])
    with pytest.raises(ValueError, match="missing"):
        fitted.predict(df.drop("name_tfidf_cosine"))
    with pytest.raises(ValueError, match="both classes"):
        model.train_matcher(df.where("label = 0"), n_folds=2, trees=2)


def test_folds_without_both_classes_do_not_count(spark):
    """A fold whose held-out part has no link can't be calibrated; it may not draw the others' probabilities to zero."""
    rng = random.Random(8)
    rows = [(f"S1-{r}", f"S2-{c}", int(c == 0), *(rng.random() + 2 * (c == 0) for _ in SCORED_FEATURES)) for r in range(120) for c in range(5)]
    df = pairs(spark, rows, "label int, " + ", ".join(f"{k} double" for k in SCORED_FEATURES))
    df = model.folds(df, 3).where("label = 0 or fold <> 2").drop("fold")
    fitted = model.train_matcher(df, n_folds=3, trees=10)
    assert len(fitted.members) == 2 and fitted.predict(df).where("label = 1").agg(F.avg("probability")).first()[0] > 0.9


def test_training_starts_few_jobs(spark):
    """Each job costs the driver memory, so their number may not grow with the trees."""
    rng = random.Random(6)
    rows = [(f"S1-{r}", f"S2-{c}", int(c == 0), *(rng.random() + (c == 0) for _ in SCORED_FEATURES)) for r in range(100) for c in range(6)]
    df = pairs(spark, rows, "label int, " + ", ".join(f"{k} double" for k in SCORED_FEATURES))
    spark.sparkContext.setJobGroup("few jobs", "")
    try:
        fitted = model.train_matcher(df, n_folds=2, trees=30)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few jobs")) < 60
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [trees.feature.shape for trees, _ in fitted.members] == [(30, 63)] * 2


def test_trees_by_hand(monkeypatch):
    rng = np.random.default_rng(4)
    codes, y = rng.integers(0, boosting.BINS, (7, 3000)).astype(np.uint8), rng.random(3000).astype(np.float32)
    rows = np.flatnonzero(rng.random(3000) < 0.5).astype(np.int32)
    for many in (1, 10**6):
        monkeypatch.setattr(boosting, "MANY", many)
        n, g = boosting._sums(boosting._keys(codes), rows, y)
        assert all(n[f, b] == (codes[f, rows] == b).sum() and g[f, b] == pytest.approx(y[rows][codes[f, rows] == b].sum(dtype=float)) for f in range(7) for b in range(boosting.BINS))
    label = (codes[2] > 11).astype(np.float32)
    made = boosting.grow(codes, label, 1, 0.5, 1, 20, 1.0, 1.0, 3)
    assert made.feature[0, 0] == 2 and made.last[0, 0] == 11
    p = made.probability(codes)
    share = label.mean()
    for side in (0, 1):
        m = (label == side).sum()
        step = 0.5 * m * (side - share) / (m * share * (1 - share) + boosting.EASE)
        assert p[label == side] == pytest.approx(1 / (1 + np.exp(-np.log(share / (1 - share)) - step)), abs=1e-5)


@pytest.mark.parametrize("name", ["ml03_ml06_matcher", "ml08_leave_one_country_out"])
def test_matcher_queries_fit_the_whole_ensemble(spark, monkeypatch, name):
    asked, made = [], model.GBTClassifier

    def recorded(**options):
        asked.append((options["maxIter"], options["stepSize"]))
        return made(**options | {"maxIter": 1})

    rows = [(f"S1-{r}", f"S2-{c}", int(c == 0), "US" if r % 2 else "India", *(float(c == 0) for _ in SCORED_FEATURES)) for r in range(120) for c in range(4)]
    df = pairs(spark, rows, "label int, source1_country string, " + ", ".join(f"{k} double" for k in SCORED_FEATURES))
    monkeypatch.setattr(model, "GBTClassifier", recorded)
    monkeypatch.setattr(catalog, "_training", lambda *_: df)
    monkeypatch.setattr(catalog, "_all_lists", lambda *_: spark.createDataFrame([(f"S1-{r}", ["S2-0"]) for r in range(120)], "ref string, ids array<string>"))
    assert catalog.queries()[name](spark, "").count() > 0
    assert asked == [(400, 0.05)] * 5


def test_training_pairs_are_blockings_with_labels_of_all_links(spark, tmp_path):
    same = "blue harbour trading and shipping company of london"
    rows = [(k, f"{same} x{k}" if k % 60 == 0 or 200 <= k < 220 else f"n{k} a{k * 7} b{k * 11} c{k * 13} d{k} e{k} f{k} g{k}", "en", f"src{k % 3}") for k in range(240)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    links = {tuple(r) for r in testdata.links(spark, str(tmp_path)).collect()}
    want = {("S1-0", f"S{k % 3 + 1}-{k}") for k, text, *_ in rows if text.startswith(same) and k % 3}
    assert links == want and len(links) > 11
    got = {(r[REF], r[CAND]): r["label"] for r in catalog._training(spark, str(tmp_path)).collect()}
    assert set(got) == {(r[REF], r[CAND]) for r in catalog.queries()["pip02_top_candidates"](spark, str(tmp_path)).collect()}
    assert {p for p, y in got.items() if y} == links


def test_programs(spark, tmp_path):
    raw = [(f"S{s}-{k}", f"{w} shop number{k} Ltd", f"{k} main road" if k % 5 else "", "US") for k, w in enumerate(["red", "blue", "green", "old", "new", "tall"] * 4) for s in (1, 2, 3)]
    (tmp_path / "raw.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in raw))
    counts = linkage.normalize(spark, [str(tmp_path / "raw.tsv")], str(tmp_path / "norm"))
    assert counts["rows"] == len(raw) and counts["entity_id"] == 0
    rec = spark.read.parquet(str(tmp_path / "norm"))
    s1, pool = rec.where("entity_id like 'S1-%'"), rec.where("not entity_id like 'S1-%'")
    linkage.block(s1, pool, str(tmp_path / "block"), k=6)
    scored = spark.read.parquet(str(tmp_path / "block/pairs")).select(*PAIR, "score")
    assert scored.groupBy(REF).count().agg(F.max("count")).first()[0] == 6
    truth = spark.createDataFrame([(f"S1-{k}", f"S2-{k},S3-{k}") for k in range(24)], f"{REF} string, matched_entity_ids string")
    parts = {"train": s1.select(F.col("entity_id").alias(REF)).where("substr(source1_entity_id, 4) % 2 = 0"), "validation": s1.select(F.col("entity_id").alias(REF)).where("substr(source1_entity_id, 4) % 2 = 1")}
    told = linkage.handoff(rec, truth, parts, scored, str(tmp_path / "hand"))
    assert told["parts"]["validation"]["micro_recall"] == 1 and json.loads((tmp_path / "hand/manifest.json").read_text())["version"]
    with pytest.raises(FileExistsError):
        linkage.handoff(rec, truth, parts, scored, str(tmp_path / "hand"))
    made = spark.read.parquet(str(tmp_path / "hand/train/features"))
    labels = spark.read.parquet(str(tmp_path / "hand/train/labels"))
    fitted = model.train_matcher(made.join(labels, PAIR), n_folds=2, trees=2)
    extractor = features.FeatureExtractor.load(spark, str(tmp_path / "hand/extractor"))
    summary = linkage.infer(s1, pool, scored, extractor, fitted, 0.5, str(tmp_path / "run"))
    assert summary["references"] == 24 and (tmp_path / "run/summary.json").exists()


def test_stream_of_raw_files(spark, tmp_path):
    from loomlink.streaming.normalize import normalize_stream

    spark.createDataFrame([("S1-1", "Acme Ltd.", "", "US")], "entity_id string, business_name string, business_address string, country string").write.parquet(f"{tmp_path}/raw")
    normalize_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").first()["name_norm"] == "acme"


def test_check_messages(spark):
    bad = spark.createDataFrame([("S1-1", ["S2-1", "S2-1"]), ("S1-1", ["S1-2"])], "ref string, ids array<string>")
    rules = {r["rule"] for r in checks.verify_outputs(bad, bad, spark.createDataFrame([("S1-3",)], "entity_id string")).collect()}
    assert {"repeated_row", "missing_reference", "unknown_reference", "repeated_id", "self_match"} <= rules


def test_result_files(spark, tmp_path):
    refs = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",), (None,)], "entity_id string")
    known = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    head = "source1_entity_id\tmatched_entity_ids\n"

    def told(matching, candidates=None, ids=None):
        for name, text in (("m.tsv", matching), ("c.tsv", candidates)):
            if text is not None:
                (tmp_path / name).write_text(text)
        at = str(tmp_path / "c.tsv") if candidates is not None else None
        found = files.validate_files(spark, str(tmp_path / "m.tsv"), at, refs, ids)
        return {(r["file"][0], r["severity"][0], r["rule"], r["entity"]) for r in found.collect()}

    absent = ("c", "w", "file_not_found", None)
    assert told(None, ids=known) == {("m", "e", "file_not_found", None), absent}
    assert told("", ids=known) == {("m", "e", "empty_file", None), absent}
    assert told("source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", ids=known) == {("m", "e", "comma_separated", None), absent}
    assert told("id\tmatches\nS1-9\tx\n", ids=known) == {("m", "e", "wrong_header", None), absent}
    fine = head.upper() + "S1-1\tS2-1,S3-1\nS1-2\t\n\nS1-3\t  \n"
    assert told(fine, ids=known) == {absent}
    assert told(fine) == {("m", "w", "ids_unchecked", None), absent}
    cand = "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\t\n"
    assert told(fine, cand, known) == {("m", "w", "not_a_candidate", "S1-1")}
    # the last of two rows counts against the candidates; a list that ends in a comma holds an empty id
    bad = head + "S1-1\tS3-1\nS1-1\tS2-1\nS1-2\tS1-1,S2-9,S2-9\nodd\nS1-9\tS2-1,\n"
    assert told(bad, cand, known) == {
        ("m", "e", "repeated_row", "S1-1"), ("m", "e", "repeated_id", "S1-2"), ("m", "e", "self_match", "S1-1"), ("m", "e", "unknown_id", "S2-9"),
        ("m", "e", "no_tab", "odd"), ("m", "e", "unknown_reference", "S1-9"), ("m", "e", "wrong_prefix", ""), ("m", "e", "missing_reference", "S1-3"),
        ("m", "w", "not_a_candidate", "S1-2"), ("m", "w", "not_a_candidate", "S1-9"),
    }
    found = files.validate_files(spark, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"), refs, known)
    most = files.summary(found, 1).where("rule = 'not_a_candidate'").first()
    assert (most["n"], most["examples"]) == (2, "S1-2")
    io.write_tsv(spark.createDataFrame([("S1-1", ""), ("S1-2", "S2-1"), ("S1-3", "")], "source1_entity_id string, matched_entity_ids string").repartition(2), str(tmp_path / "folder"))
    assert files.validate_files(spark, str(tmp_path / "folder"), None, refs, known).where("severity = 'error'").count() == 0


def test_hold_out_export(spark, tmp_path):
    rows = [(f"S1-{k}", f"S2-{k + j}", *[0.9 - 0.7 * j] * len(FEATURES), 1 - j, "US" if k % 2 else "India") for k in range(24) for j in (0, 1)]
    df = pairs(spark, rows, ", ".join(f"{c} double" for c in FEATURES) + ", label int, source1_country string")
    truth = spark.createDataFrame([(f"S1-{k}", [f"S2-{k}"]) for k in range(24)], "ref string, ids array<string>")
    told = linkage.hold_out(df, truth, "US", "India", str(tmp_path / "held"), n_folds=2, trees=2, columns=FEATURES)
    listed = json.loads((tmp_path / "held/summary.json").read_text())["files"]
    assert 0 < told["best"]["threshold"] < 1 and {p.split("/")[0] for p in listed} >= {"pairs", "sweep"}
    held = spark.read.parquet(str(tmp_path / "held/pairs"))
    assert held.count() == 24 and held.where("label IS NULL OR probability IS NULL").count() == 0
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "held/sweep")).count() == 97
    with pytest.raises(FileExistsError):
        linkage.hold_out(df, truth, "US", "India", str(tmp_path / "held"), n_folds=2, trees=2, columns=FEATURES)
