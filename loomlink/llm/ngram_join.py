"""N-gram Jaccard join: documents whose sets of word shingles overlap by 75 of 100 parts of their union, by size.

Sets are handled by size, with the boundary between light and heavy chosen by cost from the sizes that occur:

* light sets (few shingles) enumerate all their subsets of the sizes that a partner can need; two light sets link
  exactly if they share such a subset;
* heavy sets (and those light ones that could link with a heavy one) are put on the inverted lists of their rarest
  shingles, as many as any partner must hit. Rarity comes from a table of frequent shingles of bounded size, which
  decides the order only, never the result.

Equal sets are one node, named by 64 bits of a 128-bit hash; a name that stands for two sets is replaced by the other 64
bits. Lists are built in buckets of the shingles' hash range from compact blobs, one for each batch and bucket. A list
with more than `SHORT` members in one batch is long: its bucket gets a mark, and its members go round the bucket.

Lists of up to `SHORT` members give all pairs, with the number of lists that a pair shares. All that two sets have in
common up to the end of the shorter reaching prefix is on shared lists, so a pair that shares too few to make up the
overlap with all that is left is dropped before any text moves. (Members of a common long list need no pair.)

In a long list, each member is compared with one pivot, the member with most of its shingles on long lists. Two members
a, b that aren't both linked with their pivot can only link if they differ alike from its frequent shingles, the core P.
So they are put on lists again, of the rarest elements of these differences, fewer the larger the differences of both
are, in `ROUNDS` rounds of pivots. Members of lists that are long even then, and not in one component yet, are compared
in pairs of blocks of bounded size. Pairs are verified on the whole sets, gathered by pivot
in bins of bounded size. No list is cut and no link is lost; groups of near copies never meet pair by pair.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing. Rows with equal
doc_id and different texts each follow their own text. Rows with a null doc_id link with nothing and have a null
component. An empty table gives an empty one. Texts of any length are taken whole. Ties in rarity are broken by the
shingles' hashes, and change no result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlink.llm.common import U64, WordHashes, documents, mix, partitions, shingles, slices, stored, tables, tidy, words_of
from loomlink.llm.components import components

#: Links need PART * intersection >= WHOLE * union.
PART, WHOLE = 100, 75
WIDTH = 5
#: Rows of the table of frequent shingles that is broadcast (16 bytes each), and rows that one batch may add to it.
FREQUENT, FREQUENT_BATCH = 1_048_576, 65_536
#: Bytes of text that are worked on at once.
SLICE = 16 << 20
#: Lists up to this length give all pairs.
SHORT = 32
#: Entries of inverted lists in a bucket, and members in a bin of pairs to verify.
BUCKET, BIN = 1_000_000, 256
#: Rounds of pivots; members of lists that are long even then are compared in blocks.
ROUNDS = 1
#: Cost of verifying a candidate, in entries.
VERIFY = 8
LARGEST_LIGHT = 24


def required(s: int, t: int) -> int:
    """The overlap that sets of sizes s and t need to link."""
    return -(-WHOLE * (s + t) // (PART + WHOLE))


def prefix(s: int) -> int:
    """How many elements of a set any partner must hit one of."""
    return s - -(-WHOLE * s // PART) + 1


def subset_sizes(s: int) -> list[int]:
    return sorted({c for t in range(-(-WHOLE * s // PART), PART * s // WHOLE + 1) if (c := required(s, t)) <= min(s, t)})


def boundary(counts: dict[int, int]) -> int:
    """The largest light size: least total cost of subsets enumerated and of list entries with their candidates."""

    def cost(x: int) -> float:
        light = sum(n * sum(comb(s, c) for c in subset_sizes(s)) for s, n in counts.items() if s <= x)
        return light + sum(n * prefix(s) * (1 + VERIFY) for s, n in counts.items() if 4 * s > 3 * x and s <= LARGEST_LIGHT)

    return min(range(LARGEST_LIGHT + 1), key=lambda x: (cost(x), x))


def set_keys(elements: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    h = xxhash.xxh3_128_digest(elements.tobytes())
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def set_name(elements: np.ndarray, shared: frozenset[int]) -> int:
    """The node of a set: its first key, or the second where the first stands for several sets."""
    first, second = set_keys(elements)
    return second if first in shared else first


def describe(docs: DataFrame) -> DataFrame:
    """One pass over the texts: kind 0 is (id, n shingles, set keys) of a document, kind 1 (shingle, count) of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
            ids, n, keys, sets = batch.column(0), [], [], {}
            for text in batch.column(1).to_pylist():
                x = shingles(hashes.of(words_of(text)), WIDTH)
                n.append(len(x))
                keys.append(key := set_keys(x))
                sets[key] = x
            k = len(n)
            kind = np.zeros(k, np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(kind), ids.cast(pa.int64()), pa.array(n, pa.int32()), *(pa.array([x[j] for x in keys], pa.int64()) for j in (0, 1))], names)
            if not sets:
                continue
            every, times = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            top = np.flatnonzero(times > 1)
            if len(top) > FREQUENT_BATCH:
                top = top[np.argpartition(-times[top], FREQUENT_BATCH)[:FREQUENT_BATCH]]
            if len(top):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(top), np.int8)), pa.nulls(len(top), pa.int64()), pa.array(times[top].astype(np.int32)), pa.array(every[top].view(np.int64)), pa.nulls(len(top), pa.int64())], names)

    names = ["kind", "doc_id", "n", "key", "key2"]
    return docs.select("doc_id", "text").mapInArrow(run, "kind byte, doc_id long, n int, key long, key2 long")


def lists(docs: DataFrame, light: int, table: Broadcast, n_buckets: int, shared: frozenset[int]) -> DataFrame:
    """(bucket, blob): list entries of the batch's distinct sets, see packed()."""

    def entries(x: np.ndarray) -> tuple[np.ndarray, int]:
        """Keys of the set's lists, and how far its prefix reaches in the order of shingles, in 32 bits."""
        s, reach = len(x), 0
        out = []
        if s <= light:
            for c in subset_sizes(s):
                out.append(np.array([xxhash.xxh3_64_intdigest(np.array(y, U64).tobytes(), c) for y in combinations(x.tolist(), c)], U64))
        if 4 * s > 3 * light:
            x, rare, ranks = rarest_first(x, table.value)
            p = prefix(s)
            out.append(mix(x[:p]))
            reach = int(x[p - 1] >> U64(33)) if p <= rare else (1 << 32) - 1 - int(ranks[p - 1 - rare])
        return np.concatenate(out), reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (part for whole in batches for part in slices(whole, 0, SLICE)):
            seen, nodes, sizes, keys, reaches = set(), [], [], [], []
            for text in batch.column(0).to_pylist():
                x = shingles(hashes.of(words_of(text)), WIDTH)
                if not len(x) or (node := set_name(x, shared)) in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                sizes.append(len(x))
                own, reach = entries(x)
                keys.append(own), reaches.append(reach)
            if not nodes:
                continue
            yield pa.RecordBatch.from_arrays(list(packed(keys, nodes, sizes, reaches, n_buckets)), ["bucket", "blob"])

    return docs.select("text").mapInArrow(run, "bucket int, blob binary")


def packed(keys: list[np.ndarray], nodes: list[int], sizes: list[int], reaches: list[int], n_buckets: int) -> tuple[pa.Array, pa.Array]:
    """Buckets and blobs of the members' keys.

    A blob is two numbers, the entries' keys and members' places, then the members' nodes, sizes and reaches. Entries of
    lists with more than SHORT members here go to blobs of buckets from n_buckets on, of list ids, nodes and sizes; the
    list's own bucket gets one entry of size 0 for them.
    """
    member = np.repeat(np.arange(len(keys), dtype=np.int32), [len(k) for k in keys])
    if not len(member):
        return pa.array([], pa.int32()), pa.array([], pa.binary())
    every = np.concatenate(keys)
    node, size, reach = np.array(nodes, np.int64), np.array(sizes, np.int32), np.array(reaches, np.uint32)
    bucket = ((every >> U64(32)) % U64(n_buckets)).astype(np.int64)
    key = every.astype(np.uint32)
    at = np.lexsort((key, bucket))
    key, member, bucket = key[at], member[at], bucket[at]
    starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])])
    times = np.diff(np.r_[starts, len(key)])
    long = np.repeat(times, times) > SHORT
    made, blobs = [], []
    if long.any():
        ids = bucket[long] << 32 | key[long].astype(np.int64)
        made.append(n_buckets + int(node[member[long][0]]) % n_buckets)
        blobs.append(np.array([len(ids)], np.int64).tobytes() + ids.tobytes() + node[member[long]].tobytes() + size[member[long]].tobytes())
        first = np.zeros(len(key), bool)
        first[starts[times > SHORT]] = True
        stay = ~long | first
        mark = np.array([len(node)], np.int32)  # a member of size 0
        member = np.where(first, mark, member)[stay]
        key, bucket = key[stay], bucket[stay]
        node, size, reach = np.append(node, 0), np.append(size, np.int32(0)), np.append(reach, np.uint32(0))
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        own, place = np.unique(member[a:b], return_inverse=True)
        made.append(int(bucket[a]))
        blobs.append(np.array([b - a, len(own)], np.int64).tobytes() + key[a:b].tobytes() + place.astype(np.int32).tobytes() + node[own].tobytes() + size[own].tobytes() + reach[own].tobytes())
    return pa.array(made, pa.int32()), pa.array(blobs, pa.binary())


def rarest_first(x: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int, np.ndarray]:
    """x in one order for all sets, frequent shingles last and the most frequent of them at the end; how many are not
    frequent, and the ranks of those that are."""
    values, ranks = table
    none = np.zeros(0, np.int64)
    if not len(values) or not len(x):
        return x, len(x), none
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    common = values[at] == x
    if not common.any():
        return x, len(x), none
    rest, own = x[common], ranks[at[common]]
    rare = x[~common]
    by = np.argsort(-own, kind="stable")
    return np.concatenate([rare, rest[by]]), len(rare), own[by]


#: Classes of how far a set is from the core of its list, each STEP times the one before.
STEP = 1.25
_LEAST = [0, *(ceil(STEP**k) for k in range(80))]


def differences(core: np.ndarray, a: np.ndarray, pivot: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Keys of a's lists under a core P, the frequent shingles of its pivot.

    |a n b| = |P| - |P-a| - |P-b| + |(P-a) n (P-b)| + |(a-P) n (b-P)|. So a and b link only if T elements of these
    differences are the same, where 7 T >= 3 |a| - 4 |P| + 7 |P-a| + far(b), with far = 4 |P-b| + 3 |b-P|. Lists are
    kept by the classes of both; for each class that b can have, a has its rarest differences, all but T - 1. Where T
    may be 0, an element that all have is added.
    """
    inside = np.zeros(len(a), bool)
    if len(core):
        at = np.minimum(np.searchsorted(core, a), len(core) - 1)
        inside = core[at] == a
        lost = np.delete(core, at[inside])
    else:
        lost = core
    extra = a[~inside]
    order = rarest_first(np.sort(np.concatenate([extra, lost])), table)[0]
    d, n, m = len(order), len(a), len(core)
    far = 4 * len(lost) + 3 * len(extra)
    own = bisect_right(_LEAST, far) - 1
    seed = mix(np.array([pivot & ((1 << 64) - 1)], U64))
    order, out = mix(order ^ seed), []
    for k in range(len(_LEAST) - 1):
        t = -(-(3 * n - 4 * m + 7 * len(lost) + _LEAST[k]) // 7)
        if t > d:
            break
        if 3 * t >= _LEAST[k + 1]:
            continue
        mark = mix(seed + U64(100 * min(own, k) + max(own, k) + 1))
        if t <= 0:
            out.append(mark)
        out.append(mix(order[: d - max(t, 1) + 1] ^ mark))
    return np.concatenate(out) if out else np.zeros(0, U64)


def unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Keys, nodes, sizes and reaches of the entries; of a node in several blobs, those of the first.

    Two elements of one set may have equal keys; both stay, as the lists that a pair shares are counted.
    """
    keys, nodes, sizes, reaches, blob_of = [], [], [], [], []
    for k, b in enumerate(blobs):
        n, m = np.frombuffer(b, np.int64, 2)
        at = 16
        keys.append(np.frombuffer(b, np.uint32, n, at))
        place = np.frombuffer(b, np.int32, n, at + 4 * n)
        at += 8 * n
        nodes.append(np.frombuffer(b, np.int64, m, at)[place])
        sizes.append(np.frombuffer(b, np.int32, m, at + 8 * m)[place])
        reaches.append(np.frombuffer(b, np.uint32, m, at + 12 * m)[place])
        blob_of.append(np.full(n, k, np.int64))
    keys, nodes, sizes, reaches, blob_of = map(np.concatenate, (keys, nodes, sizes, reaches, blob_of))
    order = np.lexsort((blob_of, nodes))
    new = np.r_[True, nodes[order][1:] != nodes[order][:-1]]
    first = blob_of[order][new][np.cumsum(new) - 1]
    stay = np.empty(len(keys), bool)
    stay[order] = (blob_of[order] == first) | (sizes[order] == 0)
    return keys[stay], nodes[stay], sizes[stay], reaches[stay]


def candidates(listed: DataFrame, n_buckets: int, light: int | None = None) -> DataFrame:
    """kind 0: a pair (a, b) that shares n lists here and needs `least` in all. kind 1: member b, of size n, of a long
    list a.

    With `light`, sets of more shingles are listed by prefixes: what two of them have in common up to the lesser reach is
    on shared lists, and what else there can be is what the set of that reach has beyond its prefix. A size is negative
    for members that link with their pivot; two of these need no comparison.
    """

    def long_rows(blobs: list[bytes]) -> pa.Table:
        ids, nodes, sizes = [], [], []
        for b in blobs:
            n = int(np.frombuffer(b, np.int64, 1)[0])
            ids.append(np.frombuffer(b, np.int64, n, 8)), nodes.append(np.frombuffer(b, np.int64, n, 8 + 8 * n)), sizes.append(np.frombuffer(b, np.int32, n, 8 + 16 * n))
        n = sum(map(len, ids))
        return pa.table([pa.array(np.ones(n, np.int8)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(nodes)), pa.array(np.abs(np.concatenate(sizes))), pa.array(np.zeros(n, np.int32))], names)

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n_buckets:
            return long_rows(table.column("blob").to_pylist())
        keys, nodes, sizes, reaches = unpack(table.column("blob").to_pylist())
        at = np.lexsort((nodes, keys))
        keys, nodes, sizes, reaches = keys[at], nodes[at], sizes[at], reaches[at]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        length = np.diff(np.r_[starts, len(keys)])
        run_of = np.repeat(np.arange(len(starts)), length)
        marked = np.bincount(run_of, weights=sizes == 0)[run_of] > 0
        place = np.arange(len(keys)) - starts[run_of]
        is_long = marked | (length[run_of] > SHORT)
        left, right = [], []
        for d in range(1, SHORT):
            i = np.flatnonzero((place >= d) & ~is_long)
            left.append(i), right.append(i - d)
        a, b = np.concatenate(left), np.concatenate(right)
        size = np.abs(sizes).astype(np.int64)
        near = WHOLE * np.maximum(size[a], size[b]) <= PART * np.minimum(size[a], size[b])
        near &= ((sizes[a] > 0) | (sizes[b] > 0)) & (nodes[a] != nodes[b])
        a, b = a[near], b[near]
        order = np.lexsort((nodes[b], nodes[a]))
        a, b = a[order], b[order]
        new = np.r_[True, (nodes[a][1:] != nodes[a][:-1]) | (nodes[b][1:] != nodes[b][:-1])][: len(a)]
        times = np.diff(np.r_[np.flatnonzero(new), len(a)]).astype(np.int32)
        a, b = a[new], b[new]
        least = np.ones(len(a), np.int32)
        if light is not None:
            s, t = size[a], size[b]
            beyond = lambda x: x - prefix_sizes(x)
            rest = np.where(reaches[a] < reaches[b], beyond(s), np.where(reaches[b] < reaches[a], beyond(t), np.maximum(beyond(s), beyond(t))))
            need = -(-WHOLE * (s + t) // (PART + WHOLE)) - rest
            least = np.where(np.maximum(s, t) > light, np.maximum(need, 1), 1).astype(np.int32)
        open_ = np.bincount(run_of, weights=sizes >= 0)[run_of] > 0
        long = np.flatnonzero(is_long & open_ & (sizes != 0))
        ids = np.int64(bucket) << 32 | keys[long].astype(np.int64)
        kind = np.r_[np.zeros(len(a), np.int8), np.ones(len(long), np.int8)]
        return pa.table([pa.array(kind), pa.array(np.r_[nodes[a], ids]), pa.array(np.r_[nodes[b], nodes[long]]), pa.array(np.r_[times, np.abs(sizes[long])]), pa.array(np.r_[least, np.zeros(len(long), np.int32)])], names)

    names = ["kind", "a", "b", "n", "least"]
    return listed.groupBy("bucket").applyInArrow(run, "kind byte, a long, b long, n int, least int")


def prefix_sizes(s: np.ndarray) -> np.ndarray:
    return s + 1 + -WHOLE * s // PART


def paired(found: DataFrame) -> DataFrame:
    """The pairs (a, b) that share as many lists as they need."""
    met = found.where("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("least").alias("least"))
    return met.where("n >= least").select("a", "b")


def texts_of(nodes: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, text), stored: the only shuffle of all texts; later rounds need no other nodes.

    Texts are met by sort-merge joins at any size, so that shuffles grow in proportion to the input.
    """
    asked = stored(nodes.distinct().join(reps, "node"), "asked")
    return stored(docs.select("doc_id", "text").join(asked.hint("merge"), "doc_id").select("node", "text"), "texts")


def verified(pairs: DataFrame, texts: DataFrame, table: Broadcast, n_buckets: int, shared: frozenset[int]) -> DataFrame:
    """kind 0: links (u, v) that connect what pairs (a, b, star) link. kind 1: (bucket, blob) of the lists of differences
    from b, for pairs with star. Of the other pairs, those already connected in their bin are left out."""
    spark = pairs.sparkSession
    homes = pairs.groupBy("a").agg(F.min(F.struct(~F.col("star"), "b"))["b"].alias("pivot"), F.collect_list(F.struct("b", "star")).alias("with"))
    homes = stored(homes, "homes")
    n_bins = max(partitions(spark), ceil(homes.count() / BIN))
    loads = stored(homes.groupBy("pivot").count().where(F.col("count") > BIN), "loads")
    spread = F.pmod(F.xxhash64("a"), F.coalesce(F.ceil(F.col("count") / BIN), F.lit(1)))
    homes = homes.join(loads, "pivot", "left").select("a", "with", F.pmod(F.xxhash64("pivot", spread), F.lit(n_bins)).cast("int").alias("bin"))
    homes = stored(homes, "bins")
    others = homes.select(F.explode("with.b").alias("node"), "bin").distinct().select("node", "bin", F.lit(None).cast("array<struct<b:bigint,star:boolean>>").alias("with"))
    asked = stored(homes.select(F.col("a").alias("node"), "bin", "with").union(others), "asked")
    placed = asked.join(texts.hint("merge"), "node").select("bin", "node", "with", "text")

    frequent = table

    def run(table: pa.Table) -> pa.Table:
        hashes, sets, wanted = WordHashes(), {}, []
        for node, partners, text in zip(table.column("node").to_pylist(), table.column("with").to_pylist(), table.column("text").to_pylist(), strict=True):
            if node not in sets:
                x = shingles(hashes.of(words_of(text)), WIDTH)
                if set_name(x, shared) == node:
                    sets[node] = x
            if partners:
                wanted += [(not p["star"], node, p["b"]) for p in partners]
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        links, keys, nodes, sizes, cores = [], [], [], [], {}
        for plain, a, b in sorted(wanted):
            x, y = sets.get(a), sets.get(b)
            if x is None or y is None:
                continue
            i, j = top(a), top(b)
            if plain and i == j:
                continue
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            linked = PART * common >= WHOLE * (len(x) + len(y) - common)
            if not plain:
                if b not in cores:
                    ordered, rare, _ = rarest_first(y, frequent.value)
                    cores[b] = np.sort(ordered[rare:])
                keys.append(differences(cores[b], x, b, frequent.value)), nodes.append(a), sizes.append(-len(x) if linked else len(x))
            if linked and i != j:
                links.append((a, b))
                up[i] = j
        made = np.array(links, np.int64).reshape(-1, 2)
        bucket, blob = packed(keys, nodes, sizes, [0] * len(keys), n_buckets)
        n, m = len(made), len(blob)
        none = pa.nulls(m, pa.int64())
        columns = [pa.array([0] * n + [1] * m, pa.int8()), pa.concat_arrays([pa.array(made[:, 0]), none]), pa.concat_arrays([pa.array(made[:, 1]), none]), pa.concat_arrays([pa.nulls(n, pa.int32()), bucket]), pa.concat_arrays([pa.nulls(n, pa.binary()), blob])]
        return pa.table(columns, ["kind", "u", "v", "bucket", "blob"])

    return placed.groupBy("bin").applyInArrow(run, "kind byte, u long, v long, bucket int, blob binary")


def stars(long: DataFrame) -> DataFrame:
    """(a, b): members of long lists with their list's pivot, the member with most of its shingles on long lists."""
    share = stored(long.groupBy("node").agg((F.count("*") / F.max("n")).alias("share")), "shares")
    pivots = long.join(share, "node").groupBy("list").agg(F.max_by("node", F.struct("share", "node")).alias("pivot"))
    met = long.join(stored(pivots, "pivots"), "list").where("node <> pivot")
    return met.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()


def tiled(long: DataFrame, texts: DataFrame, shared: frozenset[int]) -> DataFrame:
    """(u, v): the links between members of long lists that are in different components.

    Lists that share members are one family, whose members are dealt by hash into blocks of about BIN. Each pair of
    blocks is compared in one task that gives links alone, so no pair is listed and each task's size is bounded. long is
    (list, node, component), of lists in more than one component.
    """
    first = long.groupBy("list").agg(F.min("node").alias("first"))
    held = stored(long.join(first, "list").select("node", "component", "first").distinct(), "open_members")
    family = components(held.select(F.col("node").alias("u"), F.col("first").alias("v"))).select("node", F.col("component").alias("family"))
    members = stored(held.select("node", "component").distinct().join(family, "node"), "members")
    sizes = stored(members.groupBy("family").agg(F.ceil(F.count("*") / BIN).alias("blocks")), "families")
    placed = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    met = placed.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    tile = met.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component").join(texts.hint("merge"), "node")

    def run(table: pa.Table) -> pa.Table:
        hashes, sides, seen = WordHashes(), {}, set()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        for node, part, block, text in zip(*(table.column(c).to_pylist() for c in ("node", "component", "block", "text")), strict=True):
            x = shingles(hashes.of(words_of(text)), WIDTH)
            if node not in seen and set_name(x, shared) == node:
                seen.add(node)
                sides.setdefault(block, []).append((node, part, x))
        left, right = sides.get(i, []), sides.get(j, [])
        links = []
        if left and right:
            elements = np.concatenate([x for *_, x in right])
            owners = np.repeat(np.arange(len(right)), [len(x) for *_, x in right])
            order = np.argsort(elements, kind="stable")
            elements, owners = elements[order], owners[order]
            length = np.array([len(x) for *_, x in right])
            of = np.array([p for _, p, _ in right])
            for node, part, x in left:
                a, b = np.searchsorted(elements, x, "left"), np.searchsorted(elements, x, "right")
                n = b - a
                at = np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                common = np.bincount(owners[at], minlength=len(right))
                near = np.flatnonzero((PART * common >= WHOLE * (len(x) + length - common)) & (of != part))
                for q in {int(of[k]): k for k in near}.values():
                    links.append((node, right[q][0]))
        made = np.array(links, np.int64).reshape(-1, 2)
        return pa.table([pa.array(made[:, 0]), pa.array(made[:, 1])], ["u", "v"])

    return tile.groupBy("family", "i", "j").applyInArrow(run, "u long, v long")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    before = tables(spark)
    seen = stored(describe(docs), "seen")
    described = seen.where("kind = 0")
    twice = described.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("key2").alias("x"), F.max("key2").alias("y")).where("x <> y")
    shared = frozenset(r["key"] for r in twice.select("key").collect())  # n^2 / 2^65 rows expected of n sets
    node = F.when(F.col("key").isin(*shared), F.col("key2")).otherwise(F.col("key")) if shared else F.col("key")
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), node.alias("node"))
    reps = stored(rows.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")), "reps")
    sizes = reps.agg(F.sum(prefix_column("n")).alias("entries"), *(F.count_if(F.col("n") == s).alias(f"n{s}") for s in range(1, LARGEST_LIGHT + 1))).first()
    light = boundary({s: sizes[f"n{s}"] for s in range(1, LARGEST_LIGHT + 1)})
    top = seen.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(FREQUENT)
    frequent = top.select("key").toArrow().column(0).to_numpy().view(U64)  # at most FREQUENT rows
    order = np.argsort(frequent)
    table = spark.sparkContext.broadcast((frequent[order], order))  # rank 0: the most frequent
    n_buckets = max(2 * partitions(spark), ceil((sizes["entries"] or 0) / BUCKET))
    reps_only = reps.select("node", "doc_id")
    found = stored(candidates(lists(docs.where("doc_id is not null"), light, table, n_buckets, shared), n_buckets, light), "candidates")
    edges = parts = texts = None
    for k in range(ROUNDS + 1):
        pairs, long = paired(found), found.where("kind = 1").select(F.col("a").alias("list"), F.col("b").alias("node"), "n")
        if parts is not None:
            pairs, long = across(pairs, parts), stored(unsettled(long, parts), "long")
        last = k == ROUNDS
        todo = pairs.select("a", "b", F.lit(False).alias("star"))
        if not last:
            todo = todo.union(stars(long).select("a", "b", F.lit(True)))
        todo = stored(todo.groupBy("a", "b").agg(F.max("star").alias("star")), "pairs")
        if todo.isEmpty() and (not last or long.isEmpty()):
            break
        texts = texts_of(todo.select(F.explode(F.array("a", "b")).alias("node")), docs, reps_only) if texts is None else texts
        done = stored(verified(todo, texts, table, n_buckets, shared), "verified")
        links = done.where("kind = 0").select("u", "v")
        edges = links if edges is None else edges.union(links)
        if last and not long.isEmpty():
            edges = edges.union(tiled(long, texts, shared))
        parts = stored(components(edges), "components")
        if last or not done.where("kind = 1").head(1):
            break
        found = stored(candidates(done.where("kind = 1").select("bucket", "blob"), n_buckets), "candidates")
    if parts is None:
        parts = spark.createDataFrame([], "node long, component long")
    labelled = reps_only.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = stored(labelled.join(lowest, "component").select("node", "component_id"), "by_node")
    tidy(spark, before, seen, by_node)
    out = rows.join(by_node, "node", "left")
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def unsettled(long: DataFrame, parts: DataFrame) -> DataFrame:
    """(list, node, n, component): the lists with members in more than one component."""
    held = stored(long.join(parts, "node", "left").select("list", "node", "n", F.coalesce("component", "node").alias("component")), "held")
    open_ = held.groupBy("list").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("list")
    return held.join(stored(open_, "open"), "list")


def across(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose members are not in one component yet."""
    for end in ("a", "b"):
        side = parts.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(side, end, "left")
    return pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def prefix_column(c: str):
    return F.col(c) - F.ceil(F.col(c) * WHOLE / PART) + 1


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))


QUERIES = {"op1_ngram_jaccard_join": op1_ngram_jaccard_join}
SQL: dict[str, str] = {}
