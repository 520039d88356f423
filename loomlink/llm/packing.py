"""Best-fit packing of tokenized documents into sequences, by matching of large items.

Only lengths matter for a packing, and there are at most `capacity` of them, so the plan is made on their counts:
groups of equal sequences instead of single ones. Pieces longer than a third of the capacity are large and at most two
of them share a sequence: from the largest down, each takes the largest large piece that still fits. Smaller pieces
then go, from the largest down, where the least room is left. The plan has some thousand rows at any size of input.
Each piece finds its place by its rank among the pieces of its length; ranks are counted in slices of the hash of
(doc_id, piece, place in the stored table), so that a very common length is spread over tasks even where ids repeat.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives an
empty one; other columns are ignored, whatever their names. Texts of any length are taken whole. Ties between sequences
of one room go to the last one made; between pieces of one length, to a hash's order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm import bpe
from loomlink.llm.common import documents, partitions, slices, stored

CAPACITY = 1024
END = 2


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the remainder first, then full ones."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(k, capacity) for k in range(first, n, capacity)]


def pieces(df: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, its ids."""
    path = path or bpe.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, tail = bpe.by_library(path), int(end).to_bytes(4, "little")
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                ids, rows, blobs = batch.column(0), [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    blob = machine.encode(text) + tail
                    for piece, (start, n) in enumerate(cut(len(blob) // 4, capacity)):
                        part = blob[4 * start : 4 * (start + n)]
                        rows.append((k, piece, start, n, zlib.crc32(part)))
                        if keep_ids:
                            blobs.append(part)
                made = np.array(rows, np.int64).reshape(-1, 5)
                out = [ids.take(pa.array(made[:, 0])), pa.array(made[:, 1].astype(np.int32)), *(pa.array(made[:, k]) for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays(out + ([bpe.lists(blobs)] if keep_ids else []), names)
        machine.words.clear()  # the worker lives on, and other operators need its memory

    fields = [df.schema["doc_id"], T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    names = [f.name for f in fields]
    return df.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, copies in each sequence, first sequence, offset there) for counts by length."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] += n
    open_: list[list] = [[] for _ in range(capacity + 1)]  # by room: [sequences, [(length, copies)]]
    large = capacity // 3
    for a in range(capacity, large, -1):
        while left[a]:
            b = next((b for b in range(min(a, capacity - a), large, -1) if left[b] and (b < a or left[b] > 1)), 0)
            n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
            left[a] -= n
            if b:
                left[b] -= n
            open_[capacity - a - b].append([n, [(a, 2)] if a == b else [(a, 1), (b, 1)] if b else [(a, 1)]])
    for s in range(large, 0, -1):
        room = s
        while left[s]:
            while room <= capacity and not open_[room]:
                room += 1
            if room > capacity:
                most = capacity // s
                open_[capacity].append([-(-left[s] // most), []])
                room = capacity
            group = open_[room].pop()
            most = room // s
            full = min(group[0], left[s] // most)
            if full:
                open_[room - most * s].append([full, [*group[1], (s, most)]])
            rest, group[0] = min(left[s] - full * most, most - 1) if full < group[0] else 0, group[0] - full
            left[s] -= full * most + rest
            if rest:
                open_[room - rest * s].append([1, [*group[1], (s, rest)]])
                group[0] -= 1
            if group[0]:
                open_[room].append(group)
    rows, used, first = [], [0] * (capacity + 1), 0
    for groups in open_:
        for n, items in groups:
            offset = 0
            for length, copies in items:
                rows.append((length, used[length], n * copies, copies, first, offset))
                used[length] += n * copies
                offset += length * copies
            first += n
    return rows


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """made (a stored table of pieces) with sequence_id and offset."""
    spark = made.sparkSession
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # at most `capacity` rows
    rows = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    n_slices = 4 * partitions(spark)
    sliced = made.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece", "_metadata.row_index"), F.lit(n_slices)))
    before = W.partitionBy("length").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = W.partitionBy("length", "_slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = sliced.withColumn("_at", F.row_number().over(within) - 1).join(starts.drop("_n"), ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_at")).select(*made.columns, "_rank")
    names = [*made.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            row = rows[np.searchsorted(keys, length << 44 | rank, "right") - 1] if batch.num_rows else rows[:0]
            at = rank - row[:, 1]
            out = [*(batch.column(c) for c in names[:-2]), pa.array(row[:, 4] + at // row[:, 3]), pa.array(row[:, 5] + at % row[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = T.StructType([*made.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(df: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs the documents of df (doc_id, text)."""
    return pack(stored(pieces(df, capacity, end, path, keep_ids), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
SQL: dict[str, str] = {}
