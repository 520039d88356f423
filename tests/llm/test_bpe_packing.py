import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomlink.llm import bpe, packing

PATH = bpe.default_path()
ODD = ["", "a", "aaaaaaaaaaaaa", "    x  \n\n y ", "don't we'll 'S", "naïve café ½ ²3 Ⅷ x́", "日本語テキスト", "a<|endoftext|>b <|endoftext|>", "\x1c\x1d a\x85b\xa0c\u3000d\u2009\u2028e", "___ a_b", "\U0001f600\U0001f469‍", "x" * 3000, " " * 700 + "z", "İ ǅ ƻ ×÷", "�\u0000", "١٢٣ 12.5e3"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(bpe.automaton(PATH).encode(text), "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids
    assert bpe.automaton(PATH).decode(np.array(ids(text), np.uint32)) == library.decode(ids(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("ab thein'ré \n12!", max_size=60))
def test_any_text_as_the_library(text):
    t = Tokenizer.from_file(PATH) if not hasattr(test_any_text_as_the_library, "t") else test_any_text_as_the_library.t
    test_any_text_as_the_library.t = t
    assert ids(text) == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_words_by_library_agree(text):
    assert bpe.by_library(PATH).encode(text) == bpe.automaton(PATH).encode(text)


def test_invalid_ids_decode_with_replacement(library):
    some = [random.Random(1).randrange(50257) for _ in range(500)]
    assert bpe.automaton(PATH).decode(np.array(some, np.uint32)) == library.decode(some, skip_special_tokens=False)


def test_round_trip_query_columns(spark, tmp_path, library):
    rows = [(k, t, "x") for k, t in enumerate([*ODD, None, "a", "a"])]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.op10_bpe_round_trip(spark, str(tmp_path)).collect()}
    import hashlib

    for k, t, _ in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert got[k]["n_tokens"] == len(want)
        assert got[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing_places_every_piece(spark, tmp_path, library):
    rng = random.Random(3)
    texts = [" ".join("word%d" % rng.randrange(99) for _ in range(rng.choice([0, 1, 30, 200, 400, 900]))) for _ in range(300)] + [None, "", "same", "same"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, texts[5])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = packing.op4_best_fit_packing(spark, str(tmp_path)).collect()
    n = check_packing(out, 1024)
    seen = {}
    for r in out:
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for k, t in rows:
        if k == 5:
            continue
        want = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert sorted(seen[k]) == [(p, s, m, zlib.crc32(np.array(want[s : s + m], "<u4").tobytes())) for p, (s, m) in enumerate(packing.cut(len(want), 1024))]
    assert n <= best_fit_decreasing([r["length"] for r in out], 1024)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 40)))
def test_plan_is_whole_and_tight(counts):
    rows = packing.plan(counts, 32)
    fill, seen = {}, {}
    for length, first, n, copies, seq, offset in rows:
        assert n % copies == 0 and first == seen.get(length, 0)
        seen[length] = first + n
        for k in range(n // copies):
            fill.setdefault(seq + k, []).append((offset, length * copies, length, copies))
    assert seen == {k: n for k, n in counts.items() if n}
    for items in fill.values():
        at = 0
        for offset, n, *_ in sorted(items):
            assert offset == at
            at += n
        assert at <= 32
        assert sum(c for *_, length, c in items if length > 32 // 3) <= 2
    assert sorted(fill) == list(range(len(fill)))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert bpe.op10_bpe_round_trip(spark, str(tmp_path)).count() == 0
    assert packing.op4_best_fit_packing(spark, str(tmp_path)).count() == 0
