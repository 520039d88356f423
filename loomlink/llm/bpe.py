"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, one after the other, into a deterministic automaton over tokens. It starts with one state
and an arc for each byte. The gadget of merge (u, v) adds the arc uv wherever u and then v can be read, and takes the
arc v from the state that u leads to. All arcs of one token lead to one state, so a state is named by the token read
last, and what a gadget takes away is kept as (token, token) -> rank; a merged token's state starts as a copy of its
right part's state at that rank. Every text has exactly one path, so pre-split words are encoded left to right by the
arc table, and ids are decoded by emitting the labels of their arcs.

Defined results: null and empty texts give no ids; unknown ids raise KeyError or IndexError; other columns than the
two named are ignored; repeated rows are kept; an empty table gives an empty one. Texts of any length are taken whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm.common import documents, slices

DEFAULT = "byte_bpe_50k.json"
#: Characters of a word that is remembered.
LONG = 512
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokenizer's pattern, with its white space spelled out.
FULL = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
#: In these characters the standard library's classes agree with it, at half the time.
PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def vocabulary(path: str) -> dict[bytes, int]:
    """Each entry's bytes with its id."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = byte_letters()
    return {bytes(letters[c] for c in token): k for token, k in vocab.items()}


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """The automaton of one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str, most_words: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.labels[k] = bytes(letters[c] for c in token)
        for token, k in special.items():
            self.labels[k] = token.encode()
        self.special = {k.encode(): v for k, v in special.items()}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._special = special
        self.ids = {self.labels[k]: k for k in vocab.values()}
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        self.taken: dict[tuple[int, int], int] = {}
        self._dead: set[int] = set()
        self._arcs: dict[int, bool] = {}
        self.size = size
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        for k in self._dead:
            self.ids.pop(self.labels[k], None)
        lengths: dict[bytes, set[int]] = {}
        for label in self.ids:
            lengths.setdefault(label[:2], set()).add(len(label))
        #: Lengths of the labels that begin with two bytes, from the longest down to 1.
        self.lengths = {k: tuple(sorted(v | {1}, reverse=True)) for k, v in lengths.items()}
        self.words = Words(lambda w: self.word(w.encode("utf-8", "surrogatepass")), most_words)

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        """Adds the arc uv and takes v from u's state, if v can still be read after u and uv isn't there yet."""
        if u in self._dead or v in self._dead or not self._derive(u, v):
            self._dead.add(uv) if self.born[uv] < 0 else None
            return
        self._dead.discard(uv)
        if self.born[uv] < 0:
            self.left[uv], self.right[uv], self.born[uv] = u, v, rank
        self.taken[u, v] = rank

    def arc(self, state: int, token: int) -> bool:
        """Whether the state that `state`'s arcs lead to has an arc for token."""
        key = state * self.size + token
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) > 2_000_000:
                self._arcs.clear()
            self._arcs[key] = found = self._derive(state, token)
        return found

    def _derive(self, x: int, token: int) -> bool:
        """Follows the copies back: a state has what its right part's state had when it was copied, and an arc uv
        exists where u's arc did when uv was added. Of a run of equal tokens the leftmost two merge first."""
        taken, left, right, born = self.taken, self.left, self.right, self.born
        until = 1 << 60
        while True:
            y, since = token, 1 << 60
            while True:
                rank = taken.get((x, y))
                if rank is not None and rank < until and rank <= since:
                    return False
                if left[y] < 0:
                    break
                since, y = born[y], left[y]
            if right[x] < 0:
                return True
            until, x = born[x], right[x]

    def word(self, raw: bytes) -> list[int]:
        """Ids of one pre-split word: the one path that spells it.

        Each prefix has one path at most, so a place is entered once; the longest arcs are tried first. Time is linear in
        the word's length and memory some tens of bytes for each of its bytes, however long it is.
        """
        n, ids, arcs, size, lengths = len(raw), self.ids, self._arcs, self.size, self.lengths
        whole = ids.get(raw)
        if whole is not None:
            return [whole]
        last, back = array("i", [-1]) * (n + 1), array("i", [-1]) * (n + 1)
        back[0] = 0
        open_ = [(0, iter(lengths.get(raw[:2], (1,))))]
        while open_:
            j, rest = open_[-1]
            state = last[j]
            for length in rest:
                k = j + length
                if k <= n and back[k] < 0 and (token := ids.get(raw[j:k])) is not None:
                    if not j or (arcs[key] if (key := state * size + token) in arcs else self.arc(state, token)):
                        last[k], back[k] = token, j
                        if k == n:
                            out = []
                            while k:
                                out.append(last[k])
                                k = back[k]
                            return out[::-1]
                        open_.append((k, iter(lengths.get(raw[k : k + 2], (1,)))))
                        break
            else:
                open_.pop()
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self._split is None or not any(s in text for s in self._special):
            return self._encode(text)
        out = []
        for k, part in enumerate(self._split.split(text)):
            out.append(self._special[part].to_bytes(4, "little") if k % 2 else self._encode(part))
        return b"".join(out)

    def _encode(self, text: str) -> bytes:
        words = (FAST if PLAIN.fullmatch(text) else FULL).findall(text)
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Words(dict):
    """Encoded words, forgotten when there are too many; spell gives the ids of one."""

    def __init__(self, spell: Callable[[str], list[int]], most: int):
        super().__init__()
        self.spell, self.most = spell, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = pack("<%dI" % len(ids := self.spell(word)), *ids)
        if len(word) <= LONG:
            self[word] = found
        return found


@lru_cache(2)
def automaton(path: str) -> Automaton:
    """One automaton for each Python worker and file."""
    return Automaton(path)


@lru_cache(2)
def by_library(path: str) -> Automaton:
    """Encodes as automaton(path) does, but has tiktoken merge the words of the same vocabulary: for operators that
    only need the ids."""
    machine = Automaton(path)
    ranks = dict(zip(map(machine.labels.__getitem__, machine.ids.values()), machine.ids.values(), strict=True))
    merges = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    machine.words = Words(merges.encode_ordinary, 500_000)
    return machine


def default_path() -> str:
    return public_tokenizers.path(DEFAULT)


def lists(blobs: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(blobs) + 1, np.int64)
    np.cumsum([len(b) // 4 for b in blobs], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(blobs), "<i4")))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids): the token ids of each row's text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                yield pa.RecordBatch.from_arrays([batch.column(0), lists([machine.encode(t) for t in batch.column(1).to_pylist()])], [id_col, "ids"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, ids, decoded): the text that the ids' arcs spell; bytes that aren't UTF-8 become U+FFFD."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for whole in batches:
            for batch in slices(whole, 1, 8 << 20):
                ids = batch.column(1)
                flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                texts = [machine.decode(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], [id_col, "ids", "decoded"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return df.select(id_col, ids_col).mapInArrow(run, schema)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(documents(spark, sf_dir)))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op10_bpe_round_trip": op10_bpe_round_trip}
SQL: dict[str, str] = {}
