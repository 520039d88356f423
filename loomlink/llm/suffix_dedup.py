"""Exact removal of repeated byte strings by a distributed, anchored suffix array.

Each byte covered by a LENGTH-byte string that also starts earlier (in a document of smaller id, or before in the same
one) is removed. Every string of that length has an anchor: the leftmost of its GRAM-byte runs with the least hash, so
equal strings have equal anchors at equal places. Runs of strings with one anchor form a segment.

1. Anchors are compared by hash in buckets. Strings whose anchor occurs once can't repeat and go no further. A segment
   whose bytes occur twice in one batch is kept once and marked otherwise, so common passages shrink before shuffling.
2. The suffixes at the remaining anchors are partitioned by their leading GRAM bytes, over ranges between sampled
   splitters. An anchor with more than a fair share of segments is dealt by whole strings instead. As equal leading
   bytes share a range, no string is met on both sides of a boundary.
3. Each range sorts its suffixes, and the reversed text before them, by multikey quicksort over characters of eight
   bytes, and keeps the common prefix lengths of neighbours. Two strings at one distance from their anchors are equal
   if no shorter common prefix lies between them in either order; the earliest of such a class stays.

Two shortcuts keep copies out of the suffixes and change no result: texts equal to that of a smaller doc_id are found
first, by their SHA-256, and are removed whole, as every string of theirs starts earlier there; and of segments with
equal bytes in one batch, compared as bytes, only the earliest goes on, as every string of the others starts earlier in it.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing. Rows with a null doc_id keep everything
and are no source of repeats. Rows with equal doc_id and text are one document, each returned; with equal doc_id and
different texts, a hash of the text orders them. Texts of any length are taken whole, PIECE bytes at a time. Of equal
strings that start at once in two documents' orders the smaller doc_id's stays, and in one document the earlier. Other
columns stay as they are, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm.common import U64, documents, mix, partitions, stored

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1
#: Bytes of text that are searched for anchors at once; longer texts are cut with an overlap.
PIECE = 1 << 20
_PLACE = U64((1 << 24) - 1)
MATCH = np.dtype([("at", "<i4"), ("left", "u1"), ("n", "u1"), ("hot", "u1")])
RUN = np.dtype([("at", "<i4"), ("n", "<i4")])


def text_key(raw: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(raw)
    return h - (1 << 64) if h >> 63 else h


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the GRAM bytes at the first n places of data, which is padded by GRAM bytes."""
    words = np.ndarray((n + 24,), "<u8", data.tobytes(), 0, (1,))
    h = np.zeros(n, U64)
    for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h ^= h >> U64(31)
        h += words[8 * k : 8 * k + n] * U64(odd)
        h *= U64(0xFF51AFD7ED558CCD)
    return mix(h)


def segments(raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, anchor, distance from the first string to it, strings, hash) of each segment of the texts."""
    found = []
    pieces = [(k, at, r[at : at + PIECE + LENGTH - 1]) for k, r in enumerate(raw) for at in range(0, max(1, len(r) - LENGTH + 1), PIECE) if len(r) >= LENGTH]
    while pieces:
        size, take = 0, 0
        while take < len(pieces) and (not take or size + len(pieces[take][2]) <= PIECE):
            size += len(pieces[take][2])
            take += 1
        now, pieces = pieces[:take], pieces[take:]
        data = np.frombuffer(b"".join(p[2] for p in now) + bytes(LENGTH), np.uint8)
        n = size - GRAM + 1
        h = grams(data, n)
        key = (h & ~_PLACE) | np.arange(n, dtype=U64)
        width = 1
        while 2 * width <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        key = np.minimum(key[: len(key) - (SPAN - width)], key[SPAN - width :])
        valid = np.ones(len(key), bool)
        ends = np.cumsum([len(p[2]) for p in now])
        for e in ends[:-1]:
            valid[e - LENGTH + 1 : e] = False
        first = np.flatnonzero(valid)
        at = (key[first] & _PLACE).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at, prepend=-1))
        start, at, count = first[cuts], at[cuts], np.diff(np.r_[cuts, len(first)])
        piece = np.searchsorted(ends, start, "right")
        base = np.array([p[1] for p in now]) - (ends - [len(p[2]) for p in now])
        text = np.array([p[0] for p in now])
        found.append((text[piece], at + base[piece], at - start, count, h[at]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U64),)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def anchors(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, known, blob): the batch's segments by hash range, or runs of strings known to repeat in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for ids, raw in _slices(whole, 2 * PIECE):
                keys = [text_key(r) for r in raw]
                order = sorted(range(len(ids)), key=lambda k: (ids[k], keys[k]))
                first: dict[int, int] = {}
                for k in order:
                    first.setdefault(keys[k], k)
                order = [k for k in order if first[keys[k]] == k]
                raw, ids, keys = [raw[k] for k in order], np.array([ids[k] for k in order], np.int64), np.array([keys[k] for k in order], np.int64)
                text, at, left, count, h = segments(raw)
                rows: list[tuple[int, bool, bytes]] = []
                twice = np.argsort(h, kind="stable")
                same = np.flatnonzero(h[twice][1:] == h[twice][:-1])
                twice = np.unique(np.r_[twice[same], twice[same + 1]])  # by text and place, as segments are
                seen, known = set(), []
                for k in twice.tolist():
                    start = at[k] - left[k]
                    own = (int(left[k]), raw[text[k]][start : start + count[k] + LENGTH - 1])
                    known.append(k) if own in seen else seen.add(own)
                if known:
                    k = np.array(known)
                    runs = np.stack([ids[text[k]], keys[text[k]], at[k] - left[k], count[k]])
                    rows.append((int(h[k[0]] % U64(n_buckets)), True, runs.astype(np.int64).tobytes()))
                    stay = np.ones(len(h), bool)
                    stay[k] = False
                    text, at, left, count, h = text[stay], at[stay], left[stay], count[stay], h[stay]
                bucket = ((h >> U64(32)) % U64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                    k = order[a:b]
                    own, place = np.unique(text[k], return_inverse=True)
                    parts = (h[k].astype(np.uint32), at[k].astype(np.int32), place.astype(np.int32), left[k].astype(np.uint8), count[k].astype(np.uint8), ids[own], keys[own])
                    rows.append((int(bucket[a]), False, np.array([b - a, len(own)], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "known", "blob"])

    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, known boolean, blob binary")


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[tuple[list[int], list[bytes]]]:
    ids, raw, size = [], [], 0
    for k, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
        if text is None or len(text) < LENGTH:
            continue
        ids.append(k), raw.append(text)
        size += len(text)
        if size >= most:
            yield ids, raw
            ids, raw, size = [], [], 0
    if ids:
        yield ids, raw


def _by_document(ids: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """values, in order of (id, key), as one blob for each document."""
    if not len(ids):
        return ids, keys, []
    cuts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])])
    return ids[cuts], keys[cuts], [values[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]


def matches(found: DataFrame, hot: int) -> DataFrame:
    """(known, doc_id, key, blob): segments whose anchor's hash occurs again (MATCH), or known runs (RUN)."""

    def run(table: pa.Table) -> pa.Table:
        parts, known = [], []
        for mark, blob in zip(table.column("known").to_pylist(), table.column("blob").to_pylist(), strict=True):
            if mark:
                known.append(np.frombuffer(blob, np.int64).reshape(4, -1))
                continue
            n, m = np.frombuffer(blob, np.int64, 2)
            at, out = 16, []
            for kind, k in ((np.uint32, n), (np.int32, n), (np.int32, n), (np.uint8, n), (np.uint8, n), (np.int64, m), (np.int64, m)):
                out.append(np.frombuffer(blob, kind, k, at))
                at += out[-1].nbytes
            h, place, own, left, count, ids, keys = out
            parts.append((h, place, left, count, ids[own], keys[own]))
        out = [[], [], [], []]
        if parts:
            h, at, left, count, ids, keys = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((ids, keys, left, at, h))
            h, at, left, count, ids, keys = (x[order] for x in (h, at, left, count, ids, keys))
            # A run that a piece's end cuts has one anchor in both parts; only left tells them apart.
            copy = np.r_[False, (h[1:] == h[:-1]) & (at[1:] == at[:-1]) & (left[1:] == left[:-1]) & (keys[1:] == keys[:-1])]
            h, at, left, count, ids, keys = (x[~copy] for x in (h, at, left, count, ids, keys))
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            times = np.repeat(np.diff(np.r_[starts, len(h)]), np.diff(np.r_[starts, len(h)]))
            made = np.zeros(len(h), MATCH)
            made["at"], made["left"], made["n"], made["hot"] = at, left, count, times > hot
            order = np.flatnonzero(times > 1)
            order = order[np.lexsort((at[order], keys[order], ids[order]))]
            a, b, blobs = _by_document(ids[order], keys[order], made[order])
            out = [[False] * len(blobs), a, b, blobs]
        if known:
            ids, keys, at, count = np.concatenate(known, 1)
            made = np.zeros(len(ids), RUN)
            made["at"], made["n"] = at, count
            order = np.lexsort((at, keys, ids))
            a, b, blobs = _by_document(ids[order], keys[order], made[order])
            out = [out[0] + [True] * len(blobs), np.r_[out[1], a].astype(np.int64), np.r_[out[2], b].astype(np.int64), out[3] + blobs]
        return pa.table([pa.array(out[0], pa.bool_()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())], ["known", "doc_id", "key", "blob"])

    return found.groupBy("bucket").applyInArrow(run, "known boolean, doc_id long, key long, blob binary")


def suffixes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(lead, doc_id, key, at, left, bytes): the anchored suffixes, with the text before and after them."""
    mine = found.where("not known").groupBy("doc_id").agg(F.collect_list(F.struct("key", "blob")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lead, ids, keys, ats, lefts, parts, size = [], [], [], [], [], [], 0
            for doc, text, found in zip(whole.column(0).to_pylist(), whole.column(1).cast(pa.binary()).to_pylist(), whole.column(2).to_pylist(), strict=True):
                key = text_key(text or b"")
                for own in found:
                    if own["key"] != key:
                        continue
                    for at, left, n, hot in np.frombuffer(own["blob"], MATCH).tolist():
                        gram = text[at : at + GRAM]
                        for o, count in [(left - k, 1) for k in range(n)] if hot else [(left, n)]:
                            part = text[at - o : at - o + count + LENGTH - 1]
                            lead.append(gram + xxhash.xxh3_128_digest(part) if hot else gram)
                            ids.append(doc), keys.append(key), ats.append(at), lefts.append(o), parts.append(part)
                            size += len(part)
                if size > PIECE:
                    yield batch(lead, ids, keys, ats, lefts, parts)
                    lead, ids, keys, ats, lefts, parts, size = [], [], [], [], [], [], 0
            yield batch(lead, ids, keys, ats, lefts, parts)

    def batch(lead, ids, keys, ats, lefts, parts) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((lead, ids, keys, ats, lefts, parts), kinds, strict=True)], ["lead", "doc_id", "key", "at", "left", "bytes"])

    return docs.select("doc_id", "text").join(mine, "doc_id").mapInArrow(run, "lead binary, doc_id long, key long, at int, left int, bytes binary")


def multikey_quicksort(load: Callable[[np.ndarray, int], np.ndarray], n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of n strings and the common prefix of each with the one before it, in bytes.

    load(rows, d) gives the rows' d-th characters: eight bytes each, as big-endian numbers. At each depth only runs
    that are equal so far are sorted on.
    """
    order = np.arange(n)
    prefix = np.full(n, 8 * depth, np.int32)
    if n:
        prefix[0] = 0
    where, run = order.copy(), np.zeros(n, np.int64)
    for d in range(depth):
        if not len(where):
            break
        rows = order[where]
        key = load(rows, d)
        by = np.lexsort((key, run))
        rows, key, run = rows[by], key[by], run[by]
        order[where] = rows
        inside = run[1:] == run[:-1]
        new = inside & (key[1:] != key[:-1])
        differ = key[1:][new] ^ key[:-1][new]
        equal = sum((differ < U64(1 << (64 - 8 * k))).astype(np.int32) for k in range(1, 8))
        prefix[where[1:][new]] = 8 * d + equal
        starts = np.r_[True, new | ~inside]
        ids = np.cumsum(starts)
        many = np.bincount(ids)[ids] > 1
        where, run = where[many], ids[many]
    return order, prefix


def repeats(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, keys, runs) of the strings of these suffixes that have an equal one earlier."""
    ids, keys = table.column("doc_id").to_numpy(), table.column("key").to_numpy()
    at, left = table.column("at").to_numpy().astype(np.int64), table.column("left").to_numpy().astype(np.int64)
    data = table.column("bytes").combine_chunks()
    data = data if isinstance(data, pa.BinaryArray) else data.chunk(0)
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    text = bytes(8) + bytes(data.buffers()[2] or b"") + bytes(8 * (LENGTH // 8 + 3))
    by = np.lexsort((at, keys, ids))
    ids, keys, at, left = ids[by], keys[by], at[by], left[by]
    base = offsets[:-1][by] + left + 8
    right = offsets[1:][by] + 8 - base
    low, high = left - (right + left - LENGTH), left  # distances of the last and the first string from the anchor
    big, small = np.ndarray((len(text) - 7,), ">u8", text, 0, (1,)), np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))

    def cut(words: np.ndarray, have: np.ndarray) -> np.ndarray:
        drop = np.clip(8 - have, 0, 8).astype(U64)
        return np.where(drop >= 8, U64(0), words & (~U64(0) << (U64(8) * np.minimum(drop, U64(7)))))

    def after(rows: np.ndarray, d: int) -> np.ndarray:
        have = right[rows] - 8 * d
        return cut(big[np.where(have > 0, base[rows] + 8 * d, 0)].astype(U64), have)

    def before(rows: np.ndarray, d: int) -> np.ndarray:
        have = left[rows] - 8 * d
        return cut(small[np.where(have > 0, base[rows] - 8 * d - 8, 0)].astype(U64), have)

    n = len(ids)
    order, common = multikey_quicksort(after, n, LENGTH // 8 + 1)
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(common < GRAM)
    use = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if n else np.zeros(0, np.int64)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back, shared = multikey_quicksort(before, n, (LENGTH - GRAM) // 8 + 1)
    place_back = np.empty(n, np.int64)
    place_back[back] = np.arange(n)
    codes = []
    for o in range(LENGTH - GRAM + 1):
        rows = use[(low[use] <= o) & (o <= high[use])]
        if len(rows) < 2:
            continue
        key = np.cumsum(common < LENGTH - o)[place[rows]] * (n + 1) + np.cumsum(shared < o)[place_back[rows]]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(rows), bool)
        again[first] = False
        codes.append(rows[again] * 128 + (127 - o))
    code = np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
    starts = np.flatnonzero(np.diff(code, prepend=-9) != 1)
    length = np.diff(np.r_[starts, len(code)])
    row, o = code[starts] // 128, 127 - code[starts] % 128
    made = np.zeros(len(starts), RUN)
    made["at"], made["n"] = at[row] - o, length
    return ids[row], keys[row], made


def repeated(sorted_: DataFrame) -> DataFrame:
    """(doc_id, key, blob): the runs of repeated strings that one range of suffixes shows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if sum(b.num_rows for b in batches):
            ids, keys, blobs = _by_document(*repeats(pa.Table.from_batches(batches)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "key", "blob"])

    return sorted_.mapInArrow(run, "doc_id long, key long, blob binary")


def spans(runs: np.ndarray) -> list[tuple[int, int]]:
    """Maximal (start, end) of bytes that the runs' strings cover."""
    if not len(runs):
        return []
    runs = np.sort(runs, order="at")
    start, end = runs["at"].astype(np.int64), runs["at"].astype(np.int64) + runs["n"] + LENGTH - 1
    end = np.maximum.accumulate(end)
    cuts = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return list(zip(start[cuts].tolist(), end[np.r_[cuts[1:] - 1, len(end) - 1]].tolist(), strict=True))


def dedup(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (the remaining bytes) and kept_text (them
    without characters that were cut in two); without text and without columns that have the names of these."""
    spark = docs.sparkSession
    slim = docs.select("doc_id", "text")
    told = stored(slim.where("doc_id is not null").select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").alias("n")).where(f"n >= {LENGTH}"), "digests")
    size = told.agg(F.sum("n")).first()[0] or 0
    first = stored(told.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    copies = told.join(first, "digest").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("digest").alias("_loom_copies"))
    parts = partitions(spark)
    expected = 2 * size / (SPAN + 1)
    found = matches(anchors(slim.where("doc_id is not null"), max(2 * parts, ceil(expected / 1e6))), hot=max(1000, int(expected / (8 * parts))))
    found = stored(found, "matches")
    n_ranges = max(parts, ceil(expected / 4e5))
    runs = repeated(suffixes(slim, found).repartitionByRange(n_ranges, "lead"))
    runs = stored(runs.union(found.where("known").select("doc_id", "key", "blob")), "runs")
    runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("key", "blob")).alias("_loom_runs"))
    others = [c for c in docs.columns if c not in ("text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text")]
    both = docs.join(runs.withColumnRenamed("doc_id", "_loom_id"), F.col("doc_id") == F.col("_loom_id"), "left").drop("_loom_id")
    both = both.join(copies.withColumnRenamed("doc_id", "_loom_id"), F.col("doc_id") == F.col("_loom_id"), "left").drop("_loom_id")
    both = both.select(*(F.col("`" + c.replace("`", "``") + "`").alias(f"_loom_{k}") for k, c in enumerate(others)), "text", "_loom_runs", "_loom_copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            columns = (batch.column("text").cast(pa.binary()), batch.column("_loom_runs"), batch.column("_loom_copies"))
            for text, own, copy in zip(*(c.to_pylist() for c in columns), strict=True):
                raw = text or b""
                if copy and hashlib.sha256(raw).digest() in map(bytes, copy):
                    cut = [(0, len(raw))]
                elif own:
                    key = text_key(raw)
                    blobs = [x["blob"] for x in own if x["key"] == key]
                    cut = spans(np.frombuffer(b"".join(blobs), RUN))
                else:
                    cut = []
                left, at = [], 0
                for a, b in cut:
                    left.append(raw[at:a])
                    at = b
                rest = b"".join([*left, raw[at:]])
                rows.append((len(raw), len(raw) - len(rest), len(cut), hashlib.sha256(rest).hexdigest()))
                if keep_text:
                    kept.append(rest)
            out = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            texts = [pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())] if keep_text else []
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(others))), *out, *texts], names)

    more = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    more += [T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())] if keep_text else []
    kept_columns = [T.StructField(f"_loom_{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
    names = [*(f.name for f in kept_columns), *(f.name for f in more)]
    return both.mapInArrow(run, T.StructType([*kept_columns, *more])).toDF(*others, *(f.name for f in more))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES = {"op3_suffix_array_dedup": op3_suffix_array_dedup}
SQL: dict[str, str] = {}
