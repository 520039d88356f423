import random
import re

import pytest

from loomlink.llm import ngram_join as nj


def brute(rows):
    """rows: (doc_id, text) -> {doc_id: (n, component)}"""
    sets = {}
    for k, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {k: k for k in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ks = sorted(sets)
    where = {}
    for k in ks:
        for g in sets[k]:
            where.setdefault(g, []).append(k)
    for k in ks:
        near = {j for g in sets[k] for j in where[g] if j < k}
        for j in near:
            both = len(sets[k] & sets[j])
            if 100 * both >= 75 * len(sets[k] | sets[j]):
                a, b = top(k), top(j)
                up[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), top(k)) for k in ks}


def same(spark, rows, **more):
    df = spark.createDataFrame([(k, t, "y") for k, t in rows], "doc_id long, text string, node string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.join(df).collect()}
    assert got == brute(rows)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "e%d" % rng.randrange(10**6)
    return " ".join(words)


def test_groups_chains_small_sets_and_passages(spark):
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(500)]
    word = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = ["", None, " \t\n", "one", "One", "two words", "a b c d", "a b c d e", "a b c d e f", "É é", "x" * 50_000]
    base = word(120)
    texts += [edited(rng, base, rng.randrange(9)) for _ in range(60)] + [" ".join(base)] * 5
    passage = word(60)
    texts += [" ".join(word(15) + passage + word(rng.randrange(1, 20))) for _ in range(40)]
    chain = word(100)
    for k in range(20):
        chain[4 * k] = "c%d" % k
        texts.append(" ".join(chain))
    small = word(14)
    for n in range(4, 15):
        texts += [" ".join(small[:n]), " ".join(small[-n:]), edited(rng, small[:n], 1)]
    for n in (16, 20, 26, 28, 30):
        b = word(n)
        texts += [" ".join(b), " ".join(b[1:]), " ".join(b[:-2]), " ".join([*b, "z"])]
    rng.shuffle(texts)
    same(spark, list(enumerate(texts)))


def test_empty_table_and_null_ids(spark):
    assert nj.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (2, "other words are here now then"), (None, None)]
    got = sorted(map(tuple, nj.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 2, None), (3, 2, 2), (2, 2, 2), (2, 2, 2), (None, 0, None)], key=str)


def test_boundary_follows_cost():
    assert nj.boundary({}) == 0
    assert 5 <= nj.boundary({s: 10 for s in range(1, 25)}) <= 10
    assert nj.required(4, 4) == 4 and nj.required(7, 7) == 6
    for s in range(1, 80):
        for t in range(s, 80):
            if 100 * s >= 75 * t:
                assert nj.required(s, t) in nj.subset_sizes(s) or nj.required(s, t) > s


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table_by_brute_force(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.op1_ngram_jaccard_join(spark, f"/root/testdata/{sf}").collect()}
    assert got == brute(rows)


def test_differences_lose_no_link():
    import numpy as np

    rng = random.Random(11)
    for _ in range(300):
        base = rng.sample(range(10**6), rng.randrange(3, 120))
        frequent = np.array(sorted({*rng.sample(base, len(base) // 2), *range(20)}), np.uint64)
        table = (frequent, np.arange(len(frequent)))
        core = np.array(sorted(rng.sample(base, rng.randrange(len(base) + 1))), np.uint64)
        kin = []
        for _ in range(6):
            keep = [x for x in base if rng.random() > rng.choice([0.05, 0.2, 0.4])]
            kin.append(sorted({*keep, *rng.sample(range(40) if rng.random() < 0.5 else range(10**6), rng.randrange(25))}))
        sets = [np.array(x, np.uint64) for x in kin if x]
        made = [nj.differences(core, x, 77, table) for x in sets]
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    assert len(np.intersect1d(made[i], made[j]))


def test_many_rounds(spark, monkeypatch):
    rng = random.Random(21)
    base = ["b%d" % k for k in range(70)]
    texts = [" ".join(base)]
    for _ in range(6):
        child = edited(rng, base, rng.randrange(2, 7)).split()
        texts += [edited(rng, child, rng.randrange(4)) for _ in range(25)]
    rows = list(enumerate(texts))
    same(spark, rows)
    monkeypatch.setattr(nj, "ROUNDS", 1)
    same(spark, rows)


@pytest.mark.parametrize("edges", [10**6, 40])
def test_components_against_union_find(spark, monkeypatch, edges):
    from loomlink.llm import components as cc

    monkeypatch.setattr(cc, "EDGES", edges)
    rng = random.Random(2)
    rows = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1050)] + [(2000, k) for k in range(2001, 2060)]
    up = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in rows:
        i, j = top(a), top(b)
        if i != j:
            up[max(i, j)] = min(i, j)
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {x: top(x) for e in rows if e[0] != e[1] for x in e}
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_names_of_sets():
    import numpy as np

    x = np.array([1, 2, 3], np.uint64)
    first, second = nj.set_keys(x)
    assert nj.set_name(x, frozenset()) == first and nj.set_name(x, frozenset([first])) == second != first


def test_long_lists_go_round_their_bucket():
    import numpy as np
    import pyarrow as pa

    keys = [np.array([7 << 32 | 5, k + 100], np.uint64) for k in range(nj.SHORT + 3)]
    bucket, blob = nj.packed(keys, list(range(1, len(keys) + 1)), [4] * len(keys), [9] * len(keys), 2)
    made = dict(zip(bucket.to_pylist(), blob.to_pylist()))
    ids = [b for b in made if b >= 2]
    assert len(ids) == 1
    n = int(np.frombuffer(made[ids[0]], np.int64, 1)[0])
    assert n == len(keys) and set(np.frombuffer(made[ids[0]], np.int64, n, 8).tolist()) == {1 << 32 | 5}
    entries = nj.unpack([made[1]])
    assert (entries[2] == 0).sum() == 1 and entries[0][entries[2] == 0].tolist() == [5]


def test_shared_lists_bound_the_overlap(spark):
    """Sets that share some lists but too few, and others that share just enough, among sets of other sizes."""
    rng = random.Random(9)
    vocabulary = ["v%d" % k for k in range(10_000)]
    word = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = []
    for n in (30, 60, 200, 800):
        for share in (0.3, 0.6, 0.8, 0.84, 0.85, 0.86, 0.87, 0.9, 0.95):
            base = word(n)
            texts += [" ".join(base), " ".join(base[: int(share * n)] + word(n - int(share * n)))]
            texts += [" ".join(base[: int(share * n)])]
    same(spark, list(enumerate(texts)))
