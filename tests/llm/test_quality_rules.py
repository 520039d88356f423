import math
import re
from collections import Counter

import duckdb
import pytest

from loomlink.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def rows_of(df):
    return sorted(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in df.collect())


ODD = [None, "", " \n\t\x0b\x0c\r ", "a b", "a b c", "a b a b a b", "x\ny\nx\n\n\n y \ny", "\x1c\x85a\xa0b", "the of and " * 40, "#*$%&|<> é\U0001f600" * 60, "z" * 100_000, "\n".join(["one line here"] * 30), " ".join("w%d" % k for k in range(60))]


def test_base_counts(spark, tmp_path):
    rows = [(k, t, [None, "en", "xx"][k % 3], 1) for k, t in enumerate([*ODD, *ODD])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(q.op2_quality_rules(spark, str(tmp_path)))
    assert got == sorted((k, *base(t)) for k, t, *_ in rows)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_as_sql_and_keeps_clean(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(q.SQL["op2_quality_rules"]).fetchdf()
    got = q.op2_quality_rules(spark, folder).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    key = lambda r: tuple(-1 if isinstance(x, float) and math.isnan(x) else x for x in r)
    assert sorted(map(key, got[cols].itertuples(index=False))) == sorted(map(key, want[cols].itertuples(index=False)))
    labels = con.execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchdf()
    judged = got[~got.base_failed].merge(labels, on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.995
    assert judged[judged.quality == 0].kept.mean() < 0.2


def test_rare_languages_are_no_reference_for_themselves(spark, tmp_path):
    clean = [" ".join(["the", "word", "of", "a", f"thing{k}", "and", "more"] * 1 + [f"item{k}x{j}" for j in range(70)]) for k in range(30)]
    junk = " ".join(f"@@##{j}%%" for j in range(80))
    rows = [(k, t, "en") for k, t in enumerate(clean)] + [(100, junk, "xx"), (101, junk + " 1", None), (102, clean[0], "yy")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in q.op2_quality_rules(spark, str(tmp_path)).collect()}
    assert not got[100]["base_failed"] and not got[100]["kept"] and not got[101]["kept"] and got[102]["kept"]
    assert got[100]["char_distance"] > 0.4 and not got[100]["word_distance"]


def test_native_plan(spark):
    plan = q.op2_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert q.op2_quality_rules(spark, str(tmp_path)).count() == 0
