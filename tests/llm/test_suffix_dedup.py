import hashlib
import random

import numpy as np

from loomlink.llm import suffix_dedup as sd


def brute(rows):
    seen, out = set(), {}
    for k, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            w = raw[i : i + 100]
            if w in seen:
                gone[i : i + 100] = True
            else:
                seen.add(w)
        edge = np.diff(np.r_[0, gone.astype(int)])
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[k] = (len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(rest).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def texts(rng):
    word = lambda n: " ".join(rng.choice(["the", "of", "überall", "x%d" % rng.randrange(999)]) for _ in range(n))
    passage, other = word(60), word(25)
    out = [None, "", "a" * 99, "a" * 100, "a" * 350, "ab " * 200, "Der " * 90, passage, passage, passage[:120], passage[7:180]]
    for k in range(40):
        out.append(word(rng.randrange(60)) + passage[rng.randrange(20) : 200 + rng.randrange(100)] + word(rng.randrange(60)))
        out.append(word(8) + other + word(rng.randrange(5)) + other)
    near = word(150).split()
    for k in range(30):
        copy = list(near)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = "e%d" % k
        out.append(" ".join(copy))
    rng.shuffle(out)
    return out


def test_against_brute_force(spark):
    rows = list(enumerate(texts(random.Random(2))))
    df = spark.createDataFrame([(k, t, "q") for k, t in rows], "doc_id long, text string, key string").repartition(7)
    assert result(sd.dedup(df)) == brute(rows)


def test_hot_anchors_and_small_pieces(spark, monkeypatch):
    rows = list(enumerate(texts(random.Random(9))))
    monkeypatch.setattr(sd, "PIECE", 700)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(sd.dedup(df)) == brute(rows)
    found = sd.matches(sd.anchors(df, 3), hot=1)
    runs = sd.repeated(sd.suffixes(df, found).repartitionByRange(5, "lead")).union(found.where("known").select("doc_id", "key", "blob"))
    gone = {}
    for r in runs.collect():
        gone.setdefault(r["doc_id"], []).append(bytes(r["blob"]))
    want = brute(rows)
    for k, t in rows:
        cut = sd.spans(np.frombuffer(b"".join(gone.get(k, [])), sd.RUN))
        copy = any(t == u and j < k for j, u in rows)
        assert copy or sum(b - a for a, b in cut) == want[k][1]


def test_segments_cover_each_string_once():
    rng = random.Random(4)
    raw = [bytes(rng.choices(b"abc ", k=n)) for n in (100, 101, 5000, 99, 257)] + [b"z" * 400]
    text, at, left, count, _ = sd.segments(raw)
    starts = sorted((int(t), int(a - o + k)) for t, a, o, n in zip(text, at, left, count) for k in range(n))
    assert starts == [(t, i) for t, r in enumerate(raw) for i in range(len(r) - 99)]
    assert all(0 <= a - i <= 100 - sd.GRAM for (t, a, o, n) in zip(text, at, left, count) for i in (a - o, a - o + n - 1))


def test_passages_at_the_end_of_a_piece(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    first, second = word(160), word(160)
    rows = [(0, word(sd.PIECE) + first + word(300)), (1, word(50) + first), (2, second + word(50)), (3, word(sd.PIECE) + second + word(300))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(sd.dedup(df))
    assert got == brute(rows) and got[1][1] >= 160 and got[3][1] >= 160


def test_multikey_quicksort():
    rng = random.Random(1)
    rows = [bytes(rng.choices(b"ab", k=32)) if rng.random() < 0.7 else b"a" * 32 for _ in range(500)]
    load = lambda k, d: np.array([int.from_bytes(rows[j][8 * d : 8 * d + 8], "big") for j in k], np.uint64)
    order, common = sd.multikey_quicksort(load, len(rows), 4)
    assert [rows[k] for k in order] == sorted(rows)
    for a, b, n in zip(order[:-1], order[1:], common[1:]):
        x, y = rows[a], rows[b]
        assert n == next((i for i in range(32) if x[i] != y[i]), 32)


def test_nulls_repeated_rows_and_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    long = "".join(random.Random(8).choices("abcdefgh", k=150))
    rows = [(None, long), (5, long), (5, long), (4, long), (6, None), (7, long[:100])]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in sd.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("4", 150, 0), ("5", 150, 150), ("5", 150, 150), ("6", 0, 0), ("7", 100, 100), ("None", 150, 0)]


def test_whole_table_by_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert result(sd.op3_suffix_array_dedup(spark, "/root/testdata/sf0.001")) == brute(rows)
