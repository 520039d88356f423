import hashlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loomlink.llm import chat, topk


def same_as_sql(spark, query, sql, folder, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet' )" if not folder.startswith("/tmp") else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    got = query(spark, folder)
    want = con.execute(sql).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r) for r in want[cols].itertuples(index=False))


def test_formatting_as_sql(spark):
    same_as_sql(spark, chat.op8_chat_formatting, chat.SQL["op8_chat_formatting"], "/root/testdata/sf0.01", ["conversations"])


def test_formatting_odd_rows(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\b<|im_end|>\n<|im_start|>user\nx"), (2, 5, None, "é<|"), (2, 5, "a b\n", "</s>"), (2, 5, "a b\n", "</s>"), (3, None, "assistant", "<\\|[INST"), (3, 0, "assistant", "\\"), (4, 0, "assistant", "<"), (4, 1, "assistant", "|z")]
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, msg int").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.op8_chat_formatting(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 3, 4, -7}
    for conv in (1, 2, 3, 4):
        turns = sorted(((r[1] if r[1] is not None else -1), r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learned)
    assert got[-7]["loss_chars"] == len(chat.PROBE) and got[-7]["n_turns"] == 2


def test_folding_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, 1, "message", "user", "hi"),
        (1, 2, 2, "delta", "assistant", "Hel"),
        (1, 4, 2, "delta", None, "lo"),
        (1, 3, 2, "delta", "assistant", "l"),
        (1, 5, 3, "message", "user", "more"),
        (1, 6, 4, "delta", "assistant", "old"),
        (1, 7, 2, "regenerate", "assistant", "ignored"),
        (1, 8, 2, "delta", "assistant", "Good day"),
        (1, 9, 3, "message", "user", "again"),
        (1, 10, 1, "edit", "user", "hello"),
        (2, 1, 1, "message", "user", "x"),
        (2, 2, 2, "message", "assistant", "y"),
        (2, 3, 2, "delete", None, None),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string")
    got = [tuple(r) for r in chat.fold(df).orderBy("conv_id", "msg").collect()]
    assert got == [(1, 1, "user", "hello"), (1, 2, "assistant", "Good day"), (1, 3, "user", "again"), (2, 1, "user", "x")]
    shown = chat.format_log(df).where("conv_id = 1").first()
    assert [shown["formatted"][s["start"] : s["start"] + s["length"]] for s in shown["loss"]] == ["Good day"]


def test_native_plan(spark, tmp_path):
    plan = chat.op8_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r["conv_id"] for r in chat.op8_chat_formatting(spark, str(tmp_path)).collect()] == [-7]


def test_top_k_as_sql(spark):
    same_as_sql(spark, topk.op9_exact_top_k, topk.SQL["op9_exact_top_k"], "/root/testdata/sf0.01", ["embeddings"])


@pytest.mark.parametrize("dim,n,seeds", [(5, 900, 20), (40, 700, 2048), (1, 50, 3)])
def test_top_k_against_brute_force(spark, monkeypatch, dim, n, seeds):
    monkeypatch.setattr(topk, "SEEDS", seeds)
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "TURN", 1)
    rng = random.Random(dim)
    rows = [(k, [rng.gauss(0, 1 + (k % 9)) for _ in range(dim)]) for k in range(n)]
    rows[3] = (3, None)
    rows[5] = (5, [None] * dim)
    rows[7] = (7, [math.nan] * dim)
    rows[8] = (8, [math.inf] * dim)
    rows[9] = (9, [1e30] * dim)
    rows[10] = (10, rows[11][1])
    rows[200 % n] = (200 % n, [0.0] * dim)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    ints = {k: [math.floor(1024 * x) for x in v] for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in ints:
        if q % 100 == 0:
            best = sorted((-max(min(sum(a * b for a, b in zip(ints[q], v)), 2**63 - 1), -(2**63)), k) for k, v in ints.items() if k != q)[:10]
            want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(want)


def test_top_k_of_many_queries_with_one_vector(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "TURN", 2)
    rng = random.Random(3)
    rows = [(k, [1.0, 2.0, 3.0] if k % 2 == 0 else [rng.gauss(0, 1) for _ in range(3)]) for k in range(200)]
    ints = {k: [math.floor(1024 * x) for x in v] for k, v in rows}
    want = []
    for q in range(0, 200, 2):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v)), k) for k, v in ints.items() if k != q)[:10]
        want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, every=2).collect())) == sorted(want)


def test_top_k_of_repeated_rows(spark):
    rows = [(k % 120, [float(k % 7), 1.0]) for k in range(360)]
    ints = [(k, [1024 * int(x) for x in v]) for k, v in rows]
    want = []
    for q, v in sorted({(q, tuple(v)) for q, v in ints if q % 100 == 0}):
        best = sorted((-sum(a * b for a, b in zip(v, x)), k) for k, x in ints if k != q)[:10]
        want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())) == sorted(want)


def test_top_k_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
