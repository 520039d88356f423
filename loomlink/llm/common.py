"""What the operators share: the shared folder, stored tables, words and their hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TABLES: dict[str, list[str]] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may leave it unset and gets
    a temporary one; elsewhere each executor would write to its own disk."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: the cluster must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomlink-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage is cut and a lost executor loses nothing.

    tidy() removes tables that are no longer read; the others go when the driver's process ends, or the session before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomlink-{uuid.uuid4().hex[:12]}-{name}"
    df.write.parquet(path)
    key = spark.sparkContext.applicationId
    if key not in _TABLES:
        _TABLES[key] = []
        # Taken now: a stopped session has no configuration, but its virtual machine can still remove files.
        atexit.register(_remove, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), key)
    _TABLES[key].append(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._loomlink_path = path
    return read


def tables(spark: SparkSession) -> list[str]:
    """The stored tables of this session."""
    return list(_TABLES.get(spark.sparkContext.applicationId, []))


def tidy(spark: SparkSession, before: list[str], *keep: DataFrame) -> None:
    """Removes the tables stored since `before`, but those of `keep`. Nothing that is read later may stand on them."""
    key = spark.sparkContext.applicationId
    stay = {*before, *(df._loomlink_path for df in keep)}
    gone = [path for path in _TABLES.get(key, []) if path not in stay]
    _TABLES[key] = [path for path in _TABLES.get(key, []) if path in stay]
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), gone)


def _delete(jvm, conf, paths: list[str]) -> None:
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def _remove(jvm, conf, key: str) -> None:
    _delete(jvm, conf, _TABLES.pop(key, []))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finish for 64-bit hashes."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordHashes(dict):
    """64-bit hash of each word, kept while there are under `most` of them."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8 bytes, A-Z lower-cased if asked."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(_LOWER) if lower else raw).split()


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; of the whole sequence where it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    w = min(width, n)
    x = np.full(n - w + 1, U64(w), U64)
    for k in range(w):
        x = (x ^ (x >> U64(29))) * _MUL + hashes[k : n - w + 1 + k]
    return np.unique(mix(x))


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text each, so that memory follows the longest text."""
    at, used = 0, 0
    sizes = batch.column(column)
    lengths = pc.list_value_length(sizes) if isinstance(sizes, pa.ListArray) else pc.binary_length(sizes)
    lengths = lengths.fill_null(0).to_numpy(zero_copy_only=False) * (4 if isinstance(sizes, pa.ListArray) else 1)
    for k, n in enumerate(lengths):
        used += int(n)
        if used >= most:
            yield batch.slice(at, k + 1 - at)
            at, used = k + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)
