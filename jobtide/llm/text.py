"""What several operators share: words of a text, and a folder that all executors see."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these; bytes.split() splits at the same six.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text, as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; on a local master, where none is named, a folder of its own.

    Raises ValueError on a cluster without ``spark.checkpoint.dir``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    return f"file://{tempfile.gettempdir()}/jobtide-llm"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage; removed when the session ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers, as in splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            factors = np.full(max(n, 1024) * 5 // 4, base, np.uint64)
            factors[0] = 1
            have = _powers[int(base)] = np.multiply.accumulate(factors)
    return have[:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial (Rabin-Karp) hash modulo 2 ** 64 of each span of ``codes``, whatever its place."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(_BASE, len(codes)), out=sums[1:])
        return (sums[ends] - sums[starts]) * powers(_INVERSE, len(codes) + 1)[starts]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of an UTF-8 text."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    with np.errstate(over="ignore"):
        return mix64(span_hashes(_BYTES[raw], starts, ends) + (ends - starts).astype(np.uint64) * _INVERSE)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``n`` words, from the words' hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(hashes) - n + 1)
    return mix64(span_hashes(hashes, starts, starts + n))
