import pytest

import corpus_pipeline
from loomlink.llm import bpe, pii
from loomlink.llm import quality_rules as q

from . import test_ngram_join, test_packing_helpers


def cut_text(rows):
    """What is left of each text, by brute force; None where nothing is."""
    seen, out = set(), {}
    for k, t in sorted(rows.items()):
        raw = t.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            w = raw[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\x01" * 100
            else:
                seen.add(w)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        if rest or not raw:
            out[k] = rest.decode("utf-8", "ignore")
    return out


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder).cache()
        got = {r["doc_id"]: r["text"] for r in out.collect()} if name != "best_fit_packing" else None
        if name == "quality_rules":
            verdict = {r["doc_id"]: r["kept"] for r in q.op2_quality_rules(spark, folder).collect()}
            want = {k: t for k, t in rows.items() if verdict[k]}
        elif name == "ngram_jaccard_join":
            want = {k: rows[k] for k, (_, c) in test_ngram_join.brute(list(rows.items())).items() if c == k}
        elif name == "suffix_array_dedup":
            want = cut_text(rows)
        elif name == "personal_data":
            weights = pii.train(now)
            want = {k: pii.masked(t, pii.found(t, weights)[1]) for k, t in rows.items()}
        else:
            test_packing_helpers.check(out.collect(), {k: [*bpe_ids(t), 2] for k, t in rows.items()}, 1024)
            continue
        assert got == want and out.columns == names
        assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        rows, now = want, out


def bpe_ids(text):
    import numpy as np

    return np.frombuffer(bpe.automaton(bpe.default_path()).encode(text), "<u4").tolist()


def test_odd_rows_pass_every_stage(spark):
    long = " ".join(f"word{k * k % 97} and the" for k in range(80))
    rows = [(1, long, None, "a"), (None, long + " x", "en", None), (1, long, None, "a"), (2, None, None, None), (3, "", "en", "b"), (4, "a@b.cc " + long, "xx", "b")]
    rows = [(*r, 1, 2, 3, 4, 5) for r in rows]
    names = ["n_removed", "_q", "a.b", "_row", "rest", "_kept"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` {'string' if c == 'n_removed' else 'long'}" for c in names))
    empty = spark.createDataFrame([], df.schema)
    for name, stage in corpus_pipeline.STAGES:
        for now in (df, empty):
            out = stage(spark, now, "")
            out.collect()
            assert name == "best_fit_packing" or out.columns == df.columns


def test_near_duplicates_are_decided_by_row(spark):
    text = lambda n: " ".join(f"{n}w{k}" for k in range(60))
    rows = [(1, text("a")), (2, text("a") + " end"), (2, text("b")), (3, text("b") + " end"), (4, text("c")), (4, text("c")), (4, text("c") + " end"), (5, text("c")), (None, text("a"))]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    got = sorted(map(tuple, out.collect()), key=repr)
    fours = [r for r in got if r[0] == 4]
    assert [r for r in got if r[0] != 4] == [(1, text("a")), (2, text("b")), (None, text("a"))]
    assert fours in ([(4, text("c"))] * 2, [(4, text("c") + " end")])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_run(spark, sf):
    out = corpus_pipeline.run(spark, f"/root/testdata/{sf}")
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
