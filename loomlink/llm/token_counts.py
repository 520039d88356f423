"""Token counts under a unigram model, by dynamic programming shared over a trie.

Texts are split into pre-tokens as the byte-level tokenizer does. The model's pieces are the labels of a vocabulary file;
their probabilities are estimated by expectation-maximisation over the distinct pre-tokens of all texts and how often
they occur: ROUNDS times, each pre-token is cut into its best pieces, and the pieces' counts (one number for each piece
of the vocabulary, with SMOOTH added) give the next scores. The first scores go by rank. Scores are integers, 2^16 times
the logarithm, so that sums are exact and no order of rows matters. A pre-token's tokens are its cut into pieces of the
highest total score, fewest pieces first among equals.

Distinct pre-tokens are put into a trie: the forward score of a node, the best total for its prefix, is reckoned once
from its ancestors', however many pre-tokens share the prefix, and terminal nodes give the counts. Which pieces end at a
node is told by an Aho-Corasick automaton over all pieces, whose state each node keeps: a shared prefix is read once. The
trie is dropped and begun anew past NODES nodes.
Pre-tokens over LONG bytes are no part of it: their scores are reckoned along the way and only the last few kept.

Defined results: null and empty texts have no tokens. Repeated rows are counted each, and weigh so in the estimate. An
empty table gives an empty one. Other columns are ignored, whatever their names. Texts and pre-tokens of any length are
taken whole, in time linear in them. Of cuts with equal scores and as many pieces, the one of the longest last piece
counts in the estimate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from math import ceil, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm import bpe
from loomlink.llm.common import documents, slices, stored

NODES, WORDS = 500_000, 400_000
#: Bytes of a pre-token that goes into the trie.
LONG = 512
#: Bits for the number of pieces of a pre-token in the trie, and a total below all others.
PIECES, NONE = 16, -(1 << 80)
#: Rounds of the estimate, and what is added to each piece's count.
ROUNDS, SMOOTH = 2, 1.0
#: Distinct pre-tokens of a task of the estimate.
SHARE = 100_000
#: Distinct pre-tokens that a task counts before it passes them on.
KNOWN = 200_000
#: Steps of the automaton that are kept besides those along pieces.
KNOWN_STEPS = 400_000


def matcher(pieces: list[bytes]) -> ahocorasick.Automaton:
    """Tells for each place of a string the pieces that end there, as (number, length)."""
    found = ahocorasick.Automaton()
    for k, piece in enumerate(pieces):
        if piece:
            found.add_word(piece.decode("latin-1"), (k, len(piece)))
    found.make_automaton()
    return found


class Ends:
    """An Aho-Corasick automaton that goes on byte by byte: links and the pieces of a state are derived when first asked
    for and kept, so a node of a trie can hold the state of its prefix and no prefix is read again."""

    def __init__(self, pieces: list[bytes]):
        self.child: dict[int, int] = {}
        self.above, self.byte, self.own = [0], [0], [-1]
        child = self.child
        for k, piece in enumerate(pieces):
            state = 0
            for byte in piece:
                below = child.get(state << 8 | byte)
                if below is None:
                    child[state << 8 | byte] = below = len(self.own)
                    self.above.append(state), self.byte.append(byte), self.own.append(-1)
                state = below
            if state:
                self.own[state] = k
        self.lengths = [len(piece) for piece in pieces]
        self.links = [0] + [-1] * (len(self.own) - 1)
        self.known: dict[int, int] = {}
        self.told: dict[int, tuple[tuple[int, int], ...]] = {0: ()}

    def link(self, state: int) -> int:
        """The state of the longest proper suffix that begins a piece."""
        if (found := self.links[state]) < 0:
            above = self.above[state]
            self.links[state] = found = self.step(self.link(above), self.byte[state]) if above else 0
        return found

    def step(self, state: int, byte: int) -> int:
        key = state << 8 | byte
        found = self.child.get(key)
        if found is None and (found := self.known.get(key)) is None:
            found = self.step(self.link(state), byte) if state else 0
            if len(self.known) >= KNOWN_STEPS:
                self.known.clear()
            self.known[key] = found
        return found

    def at(self, state: int) -> tuple[tuple[int, int], ...]:
        """The pieces that end there as (number, length), the longest first."""
        if (found := self.told.get(state)) is None:
            own, rest = self.own[state], self.at(self.link(state))
            self.told[state] = found = ((own, self.lengths[own]), *rest) if own >= 0 else rest
        return found


class Trie:
    """Forward scores of the prefixes seen so far, under pieces with scores."""

    def __init__(self, pieces: list[bytes], scores: list[int], ends: Ends | None = None, whole: Callable[[], ahocorasick.Automaton] | None = None):
        self.scores, self.longest = scores, max(map(len, pieces))
        self.weights = [(x << PIECES) - 1 for x in scores]
        self.ends = ends or Ends(pieces)
        self.whole = whole or lru_cache(1)(lambda: matcher(pieces))  # for long strings only
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score = [0]  # the best cut's score above its last PIECES bits, less its pieces: one order of both
        self.piece, self.start = [-1], [-1]  # the last piece of the best cut, and the node before it
        self.state = [0]  # of the automaton, after the node's prefix

    def node(self, raw: bytes) -> int:
        """The node of raw, put in if it is new."""
        child, score, weights, ends = self.child, self.score, self.weights, self.ends
        node, path = 0, [0]
        for byte in raw:
            if (node := child.get(node << 8 | byte, -1)) < 0:
                break
            path.append(node)
        at = len(path) - 1
        if at == len(raw):
            return path[-1]
        sums, state = [score[x] for x in path], self.state[path[-1]]
        for at in range(at, len(raw)):
            state = ends.step(state, raw[at])
            best, piece, start = NONE, -1, -1
            for k, n in ends.told.get(state) or ends.at(state):  # the longest comes first
                if (one := sums[at + 1 - n] + weights[k]) > best:
                    best, piece, start = one, k, at + 1 - n
            if best == NONE:
                raise ValueError("the vocabulary lacks a byte")
            child[path[-1] << 8 | raw[at]] = new = len(score)
            path.append(new), sums.append(best), score.append(best)
            self.piece.append(piece), self.start.append(path[start]), self.state.append(state)
        return path[-1]

    def full(self) -> bool:
        return len(self.score) > NODES

    def tokens(self, raw: bytes) -> int:
        """The number of pieces of the best cut of raw."""
        if len(raw) > LONG:
            return self.along(raw)[0]
        if self.full():
            self.clear()
        return -self.score[self.node(raw)] & (1 << PIECES) - 1

    def pieces_of(self, times: dict[int, int]) -> Counter:
        """How often each piece is in the best cuts of the nodes' strings, each taken so many times: what a node has is
        passed on to the node before its last piece, from the youngest down, so a shared prefix is cut once."""
        flow, used = [0] * len(self.score), Counter()
        for node, n in times.items():
            flow[node] += n
        for node in range(len(flow) - 1, 0, -1):
            if n := flow[node]:
                used[self.piece[node]] += n
                flow[self.start[node]] += n
        return used

    def cut(self, raw: bytes) -> Counter:
        """How often each piece is in the best cut of raw."""
        return self.along(raw, keep=True)[1] if len(raw) > LONG else self.pieces_of({self.node(raw): 1})

    def along(self, raw: bytes, keep: bool = False) -> tuple[int, Counter]:
        """Pieces of a long string; with `keep`, also which (four bytes a byte), else only the last scores are held."""
        size = self.longest + 1
        score, count = [0] * size, [0] * size
        lasts = np.zeros(len(raw) + 1 if keep else 0, np.int32)
        lengths = np.zeros(len(raw) + 1 if keep else 0, np.uint16)
        at, best, fewest, how = 1, None, 0, (-1, 0)
        for end, (k, n) in self.whole().iter(raw.decode("latin-1")):
            if end >= at:
                if best is None or end > at:
                    raise ValueError("the vocabulary lacks a byte")
                score[at % size], count[at % size] = best, fewest
                if keep:
                    lasts[at], lengths[at] = how
                at, best = end + 1, None
            start = (end + 1 - n) % size
            total, pieces = score[start] + self.scores[k], count[start] + 1
            if best is None or total > best or total == best and (pieces, -n) < (fewest, -how[1]):
                best, fewest, how = total, pieces, (k, n)
        if best is None or at != len(raw):
            raise ValueError("the vocabulary lacks a byte")
        used: Counter = Counter()
        if keep:
            lasts[at], lengths[at] = how
            while at:
                used[int(lasts[at])] += 1
                at -= int(lengths[at])
        return fewest, used


class Counts(dict):
    """Tokens of each pre-token; long ones are reckoned each time. At WORDS the words in hand become the old ones, and of
    those only what is asked for again comes back, so frequent words outlast the rare."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie, self.old = trie, {}

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            n = self.trie.tokens(word.encode("utf-8", "surrogatepass"))
        if len(word) <= LONG:
            if len(self) >= WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = n
        return n

    def learn(self, words: set[str]) -> None:
        """Reckons the new words in order, which keeps to one part of the trie at a time; half a table at most."""
        for word in sorted(words.difference(self))[: WORDS // 2]:
            if len(word) <= LONG:
                self[word]


def first_scores(n: int) -> list[int]:
    """Scores by rank, as word frequencies fall."""
    return [-round(65536 * log(k + 2)) for k in range(n)]


def next_scores(used: dict[int, int], n: int) -> list[int]:
    total = sum(used.values()) + SMOOTH * n
    return [round(65536 * log((used.get(k, 0) + SMOOTH) / total)) for k in range(n)]


@lru_cache(2)
def vocabulary(path: str) -> list[bytes]:
    """The vocabulary's pieces in order of rank."""
    return [piece for piece, _ in sorted(bpe.vocabulary(path).items(), key=lambda x: x[1])]


@lru_cache(2)
def matcher_of(path: str) -> ahocorasick.Automaton:
    return matcher(vocabulary(path))


@lru_cache(2)
def ends_of(path: str) -> Ends:
    return Ends(vocabulary(path))


def trie_of(path: str, scores: list[int]) -> Trie:
    return Trie(vocabulary(path), scores, ends_of(path), partial(matcher_of, path))


@lru_cache(1)
def counts_of(path: str, scores: tuple[int, ...]) -> Counts:
    """One table of counts for each Python worker, so that its tasks share the trie."""
    return Counts(trie_of(path, list(scores)))


def pre_tokens(text: str) -> list[str]:
    return (bpe.FAST if bpe.PLAIN.fullmatch(text) else bpe.FULL).findall(text)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): the distinct pre-tokens of all texts as UTF-8, and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8", "surrogatepass") for w in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return rows

        for whole in batches:
            for batch in slices(whole, 0, 4 << 20):
                for text in batch.column(0).to_pylist():
                    seen.update(pre_tokens(text or ""))
                if len(seen) > KNOWN:
                    yield out()
        yield out()

    return df.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def estimate(df: DataFrame, text_col: str = "text", path: str | None = None, rounds: int = ROUNDS) -> list[int]:
    """Scores of the vocabulary's pieces, by rank, from all texts of df."""
    path = path or bpe.default_path()
    spark = df.sparkSession
    scores = first_scores(len(vocabulary(path)))
    words = stored(word_counts(df, text_col), "words")
    n_tasks = max(1, ceil(words.count() / SHARE))
    words = stored(words.repartitionByRange(n_tasks, "word").sortWithinPartitions("word"), "sorted_words")  # prefixes together
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(scores)  # one number for each piece

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            trie, used, times = trie_of(path, shared.value), Counter(), {}
            for batch in batches:
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if len(word) > LONG:
                        for k, m in trie.cut(word).items():
                            used[k] += n * m
                        continue
                    if trie.full():
                        used += trie.pieces_of(times)
                        trie.clear(), times.clear()
                    node = trie.node(word)
                    times[node] = times.get(node, 0) + n
            used += trie.pieces_of(times)
            yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.int32()), pa.array(list(used.values()), pa.int64())], ["piece", "n"])

        told = words.mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
        scores = next_scores({r["piece"]: r["n"] for r in told}, len(scores))
    return scores


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, scores: list[int] | None = None) -> DataFrame:
    """(id, n_pretokens, n_distinct, n_tokens) of each row's text, under these scores or those that its texts give."""
    path = path or bpe.default_path()
    shared = df.sparkSession.sparkContext.broadcast(tuple(scores or estimate(df, text_col, path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_of(path, shared.value)
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                texts = [pre_tokens(text or "") for text in batch.column(1).to_pylist()]
                apart = [set(words) for words in texts]
                counts.learn(set().union(*apart))
                rows = [(len(words), len(own), sum(map(counts.__getitem__, words))) for words, own in zip(texts, apart, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], [id_col, *NAMES])

    schema = T.StructType([df.schema[id_col], *(T.StructField(c, T.LongType()) for c in NAMES)])
    return df.select(id_col, text_col).mapInArrow(run, schema)


NAMES = ["n_pretokens", "n_distinct", "n_tokens"]


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))


QUERIES = {"op6_token_counts": op6_token_counts}
SQL: dict[str, str] = {}
