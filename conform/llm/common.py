"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.session import scratch_dir

Plan = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """The frame written once to the shared scratch folder and read back: lineage ends there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return a worker's free memory to the system, as workers are reused by later stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidied(function: Callable) -> Callable:
    """A batch function that gives its memory back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts of a column one by one, null as empty, so that a batch is not held twice."""
    for text in column:
        yield text.as_py() or ""


def fresh(*taken: DataFrame, stem: str) -> str:
    """A column name that none of the frames has, in any case."""
    names = {c.lower() for df in taken for c in df.columns}
    return next(n for n in (f"{stem}{'_' * i}" for i in range(len(names) + 1)) if n.lower() not in names)


# -- words as 64-bit numbers ---------------------------------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """64-bit hashes of words, remembered up to a bound; the same in every process."""

    def __init__(self, bound: int = 200_000) -> None:
        import xxhash

        self.known: dict[bytes, int] = {}
        self.bound, self.digest = bound, xxhash.xxh3_64_intdigest

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, self.digest
        if len(known) > self.bound:
            known.clear()
        out = []
        for word in words:
            h = known.get(word)
            if h is None:
                h = known[word] = digest(word)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words in order; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    total = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total = total * _MULTIPLIER + words[j : n - size + 1 + j]
    return mix(total)


# -- bounded bitmaps over unbounded keys ----------------------------------------------------


def bitmap(df: DataFrame, key: str, bits: int = 1 << 24, slices: int = 64) -> np.ndarray:
    """A bit per residue of a 64-bit key: ``bits`` / 8 bytes whatever the number of rows.

    Each task fills its own bitmap, the bitmaps are merged slice by slice, and the
    driver receives one merged bitmap. A key that is present is always found; one that is
    absent passes with a chance that grows with the number of keys, so the bitmap only thins
    rows before an exact join.
    """
    width = bits // slices

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            keys = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.unique(slot(keys, bits))
            byte, first = np.unique(at >> 3, return_index=True)
            if len(byte):
                seen[byte] |= np.bitwise_or.reduceat((128 >> (at & 7)).astype(np.uint8), first)
        packed = [part.tobytes() if part.any() else None for part in seen.reshape(slices, width // 8)]
        there = [i for i, p in enumerate(packed) if p is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array([packed[i] for i in there], pa.binary())], ["slice", "bits"]
        )

    def merge(table: pa.Table) -> pa.Table:
        out = np.zeros(width // 8, dtype=np.uint8)
        for part in table.column("bits"):
            out |= np.frombuffer(part.as_py(), dtype=np.uint8)
        return pa.table({"slice": table.column("slice").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    rows = (
        df.select(F.col(key).cast("long"))
        .mapInArrow(tidied(fill), "slice int, bits binary")
        .groupBy("slice")
        .applyInArrow(merge, "slice int, bits binary")
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        start = row["slice"] * (width // 8)
        out[start : start + width // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def maybe_in(bitmap_bytes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a bitmap may hold."""
    at = slot(keys, len(bitmap_bytes) * 8)
    return (bitmap_bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def flagged(seen: np.ndarray, key: str) -> Column:
    """Whether a bitmap may hold the row's key; false for null."""

    @F.arrow_udf("boolean")
    def test(keys: pa.Array) -> pa.Array:
        there = keys.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(maybe_in(seen, keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) & there)

    return test(F.col(key).cast("long"))


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``gone``; rows with a null key stay.

    A bitmap tells which rows surely stay, and only the others are shuffled to the exact anti join.
    """
    gone = stored(gone.select(key).distinct(), "gone")
    maybe = flagged(bitmap(gone, key), key)
    return df.where(~maybe).unionByName(df.where(maybe).join(gone, key, "left_anti"))


def bits_of(df: DataFrame, key: str, bits: int = 1 << 22) -> DataFrame:
    """Like :func:`bitmap`, in SQL functions only: at most ``bits`` / 64 rows (word, bits) with one bit per residue of the key's hash."""
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    words = df.select((at / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def with_bit(df: DataFrame, words: DataFrame, key: Column, out_col: str, bits: int = 1 << 22) -> DataFrame:
    """``df`` with whether the rows of :func:`bits_of` may hold the key. They are broadcast; as a literal they would stand
    in every text that the driver keeps of the plan."""
    word, found, place = fresh(df, stem="word"), fresh(df, stem="bits"), fresh(df, stem="place")
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    words = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(found)))
    bit = F.call_function("shiftright", F.col(found), (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    joined = df.withColumn(place, (at / 64).cast("int")).join(words, F.col(place) == F.col(word), "left")
    return joined.select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias(out_col))


# -- compact columns for blocks of documents -----------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers by byte planes, compressed."""
    data = np.ascontiguousarray(values, dtype="<u4")
    planes = data.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(data).to_bytes(4, "little") + pa.Codec("zstd", 3).compress(planes, asbytes=True) if len(data) else b"\0\0\0\0"


def unsqueeze(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    if not n:
        return np.empty(0, dtype=np.uint32)
    planes = pa.Codec("zstd").decompress(packed[4:], 4 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, n).T).view("<u4").ravel()


def pack_words(words: list[str]) -> bytes:
    parts = [w.encode("utf-8", "surrogatepass") for w in words]
    joined = b"".join(parts)
    sizes = squeeze(np.array([len(p) for p in parts], dtype=np.uint32))
    body = pa.Codec("zstd", 3).compress(joined, asbytes=True) if joined else b""
    return len(sizes).to_bytes(4, "little") + len(joined).to_bytes(4, "little") + sizes + body


def unpack_words(packed: bytes) -> list[str]:
    n, size = int.from_bytes(packed[:4], "little"), int.from_bytes(packed[4:8], "little")
    ends = np.cumsum(unsqueeze(packed[8 : 8 + n])).tolist()
    joined = pa.Codec("zstd").decompress(packed[8 + n :], size, asbytes=True) if size else b""
    return [joined[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends, strict=False)]


def by_bucket(words: list[str], buckets: int) -> tuple[np.ndarray, list[tuple[int, list[str]]]]:
    """New places of the words when they are put in order of their hash bucket, and each bucket's words in that order."""
    import xxhash

    if not words:
        return np.empty(0, dtype=np.int64), []
    digest = xxhash.xxh3_64_intdigest
    bucket = np.array([digest(w.encode("utf-8", "surrogatepass")) % buckets for w in words], dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(words), dtype=np.int64)
    place[order] = np.arange(len(words))
    there, starts = np.unique(bucket[order], return_index=True)
    ends = [*starts[1:].tolist(), len(words)]
    parts = [(int(b), [words[i] for i in order[s:e]]) for b, s, e in zip(there, starts.tolist(), ends, strict=True)]
    return place, parts
