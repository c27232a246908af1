"""Helpers shared by the corpus operators: table access, scratch tables, bounded bitmaps, and
vectorised word and byte-window hashing over Arrow batches.

Hashing works on a whole chunk of documents at once.  A text is a row of UTF-8 bytes; NULL is
read as empty.  Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D, which is
``[^\\x20\\x09-\\x0D]+`` on the text."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text handled at once by the numpy code; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Least and most bits of a broadcast bitmap (128 KiB to 32 MiB), and the bits for each key between.
BITMAP_LEAST, BITMAP_MOST, BITMAP_PER_KEY = 1 << 20, 1 << 28, 32

# ---------------------------------------------------------------------------------------
# tables and scratch space
# ---------------------------------------------------------------------------------------


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it
    wherever the driver was started."""
    root = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _shipped or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="larder-code-")) / f"{root.name}-code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; any further columns of the file are left alone."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Where the session names none, a local master gets a
    temporary one; any other master is refused, because executors could not share it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="larder-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


class Scratch:
    """Tables written under the shared folder to cut lineage.  ``drop`` deletes one as soon as
    no reader needs it; what a returned DataFrame still reads is deleted when Python exits."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/larder-{name}-{uuid.uuid4().hex}"
        self.live: set[str] = set()
        atexit.register(self.close)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.live.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")
            self.live.discard(name)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def lowest_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at least, those with the lowest hash of ``key``, chosen by a cut on the hash and
    not by sorting, so that no task or driver merges ``most`` rows of every partition.  All rows
    where there are fewer; a ``limit`` behind it makes the bound exact."""
    n = rows.count()
    share = (most + 6 * most ** 0.5 + 10) / max(n, 1)
    return rows if share >= 1 else rows.where(F.xxhash64(key) < F.lit(int(share * 2.0 ** 64) - 2 ** 63))


def bitmap(keys: DataFrame, column: str, bits: int | None = None) -> np.ndarray:
    """A bitmap with the bit ``key mod bits`` set for every 64-bit key.  Without ``bits`` its size follows
    the number of rows of ``keys``, up to a bound (beyond it the filter only gets weaker).

    Used as a broadcast prefilter: a clear bit proves that a key is absent, a set bit proves
    nothing, so an exact step always follows.  Tasks assemble blocks of 8192 bits; the driver
    receives each block once, at most ``bits / 8`` bytes in all, whatever the data."""
    block = 8192
    if bits is None:
        bits = BITMAP_LEAST
        wanted = BITMAP_PER_KEY * keys.count()
        while bits < min(wanted, BITMAP_MOST):
            bits *= 2

    def local(batches):
        for batch in batches:
            key = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) & (bits - 1))
            number, low = key // block, (key % block).astype(np.int16)
            heads = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(key) else np.zeros(0, int)
            ends = np.r_[heads[1:], len(key)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(number[heads], pa.int64()),
                "low": pa.array([low[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary())})

    def assemble(batches):
        marks: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = marks.setdefault(number, np.zeros(block, np.uint8))
                mark[np.frombuffer(low, np.int16)] = 1
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(list(marks), pa.int64()),
            "part": pa.array([np.packbits(m, bitorder="little").tobytes() for m in marks.values()], pa.binary())})

    parts = keys.select(F.col(column).cast("long")).na.drop().mapInArrow(local, "block long, low binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.repartition("block").mapInArrow(assemble, "block long, part binary").collect():
        at = row["block"] * (block // 8)
        out[at:at + block // 8] |= np.frombuffer(bytes(row["part"]), np.uint8)
    return out


def in_bitmap(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(U64) & U64(len(marks) * 8 - 1)
    return (marks[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1


# ---------------------------------------------------------------------------------------
# Arrow batches -> bytes
# ---------------------------------------------------------------------------------------


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n + 1 offsets) of a string or binary column; NULL is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


#: How to drop what an operator keeps in a Python worker between tasks, where it keeps anything.
HELD: list[Callable] = []


def release() -> None:
    """Drop what other operators' tasks left in this Python worker, which lives through many stages."""
    for drop in HELD:
        drop()


def chunks(batches, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` bytes of text each: (slice, bytes, offsets)."""
    for batch in batches:
        data, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), n)
            at = offsets[start:stop + 1]
            yield batch.slice(start, stop - start), data[at[0]:at[-1]], at - at[0]
            start = stop


# ---------------------------------------------------------------------------------------
# words and hashes
# ---------------------------------------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_COEF = _rng.integers(1, 1 << 63, 512, dtype=np.uint64) | U64(1)
_BASE = int(_rng.integers(1, 1 << 62)) * 4 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base & (2**64 - 1), U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 8 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the multiply-xorshift steps of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c such that (c[e] - c[s]) * inverse ** s identifies the bytes s..e-1."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-byte window of the data behind ``prefix``."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, U64)
    return mix((prefix[width:] - prefix[:n]) * powers(_INVERSE, n))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte) of every word and the n + 1 word offsets of the documents."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: A longer word is named by a digest of its bytes instead of lane by lane.
LONG_WORD = 256


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits that name every word; another ``seed`` gives independent names.

    A word is read in lanes of eight bytes, each mixed into the state by a bijection, so no two
    words of up to eight bytes share a name and longer ones meet by chance only (a polynomial
    modulo 2 ** 64 has fixed collisions, whatever its base)."""
    size = ends - starts
    state = mix(size.astype(U64) * _COEF[511] + _COEF[510 - seed])
    if not len(size):
        return state
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    rows, at, left = np.flatnonzero(size <= LONG_WORD), starts, size
    if len(rows) < len(size):
        body, key = data.tobytes(), seed.to_bytes(8, "little")
        for i in np.flatnonzero(size > LONG_WORD):
            state[i] = int.from_bytes(hashlib.blake2b(body[starts[i]:ends[i]], digest_size=8, salt=key).digest(), "little")
    while len(rows):
        lane, some = lanes[at[rows]], left[rows]
        short = some < 8
        lane[short] &= (U64(1) << (some[short].astype(U64) * U64(8))) - U64(1)
        state[rows] = mix(state[rows] ^ lane) + _COEF[500]
        rows = rows[some > 8]
        at, left = at + 8, left - 8
    return state


def sequence_hashes(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (one row per start)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(width):
        out += hashes[i:i + n] * _COEF[(i + 64 * salt) % 511]
    return mix(out)


def starts_inside(offsets: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over starts 0..n-width: the window lies inside one document."""
    total = n - width + 1
    if total <= 0:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return owner[:total] == owner[width - 1:]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---------------------------------------------------------------------------------------
# texts by content
# ---------------------------------------------------------------------------------------


def digest(text: bytes) -> tuple[int, int]:
    """96 bits that name a text, as a signed 64-bit and a signed 32-bit number.  What an operator
    finds out about a text depends on its content only, so it is keyed by this and not by a row."""
    found = hashlib.blake2b(text, digest_size=12).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)


class Seen:
    """Texts that this task has met, up to a bounded number; used to skip exact copies early."""

    def __init__(self, remember: int = 100_000):
        self.names: set = set()
        self.remember = remember

    def again(self, name) -> bool:
        if name in self.names:
            return True
        if len(self.names) >= self.remember:
            self.names.clear()
        self.names.add(name)
        return False


def copies(docs: DataFrame, size_of, least: int) -> DataFrame:
    """(t1, t2, copies) of texts of ``size_of(bytes) >= least`` that occur twice or more.  Counts
    are combined before the shuffle, so a text with any number of copies is one row a task."""
    def run(batches):
        for _, data, offsets in chunks(batches, "text"):
            body = data.tobytes()
            names = [digest(t) for t in (body[a:b] for a, b in zip(offsets[:-1], offsets[1:])) if len(t) >= least and size_of(t) >= least]
            yield pa.RecordBatch.from_pydict({"t1": pa.array([n[0] for n in names], pa.int64()), "t2": pa.array([n[1] for n in names], pa.int64())})

    rows = docs.select("text").mapInArrow(run, "t1 long, t2 long")
    return rows.groupBy("t1", "t2").agg(F.count("*").alias("copies")).where("copies > 1")


def finish(docs: DataFrame, whole: DataFrame, covered: DataFrame, removed: Callable, size_of: Callable, kept_hash: Callable,
           names: tuple[str, ...]) -> DataFrame:
    """One row per document: doc_id, size, ``names`` counts and kept_sha256.

    ``whole``: (t1, t2) of texts that are removed wholly; ``covered``: (t1, t2, found list) of the
    others that lose something.  Only texts whose bit is set in a bitmap of ``covered`` travel with
    their row; the join decides.  ``removed(text, found)`` gives (counts, kept_sha256)."""
    marks = bitmap(covered, "t1")
    kinds = docs.schema["doc_id"].dataType.simpleString()

    def name(batches):
        for part, data, offsets in chunks(batches, "text"):
            body = data.tobytes()
            texts = [body[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            keys = [digest(t) for t in texts]
            t1 = np.array([k[0] for k in keys], np.int64)
            touched = in_bitmap(marks, t1.view(U64)) if len(t1) else np.zeros(0, bool)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(part.schema.get_field_index("doc_id")), "t1": pa.array(t1), "t2": pa.array([k[1] for k in keys], pa.int64()),
                "size": pa.array([size_of(t) for t in texts], pa.int64()), "hash": pa.array([kept_hash(t) for t in texts], pa.string()),
                "body": pa.array([t if hit else None for t, hit in zip(texts, touched)], pa.binary())})

    rows = docs.select("doc_id", "text").mapInArrow(name, f"doc_id {kinds}, t1 long, t2 long, size long, hash string, body binary")
    joined = rows.join(covered, ["t1", "t2"], "left").join(whole.select("t1", "t2", F.lit(True).alias("whole")), ["t1", "t2"], "left")
    nothing = kept_hash(b"")

    def settle(batches):
        for batch in batches:
            ids, size, sha, body, found, gone = (batch.column(i) for i in range(6))
            counts, hashes = [], []
            for n, h, text, at, all_gone in zip(size.to_pylist(), sha.to_pylist(), body, found, gone.to_pylist()):
                if all_gone:
                    counts.append((n, 1)[:len(names)])
                    hashes.append(nothing)
                elif at.is_valid:
                    c, h = removed(text.as_py(), at.values)
                    counts.append(c[:len(names)])
                    hashes.append(h)
                else:
                    counts.append((0, 0)[:len(names)])
                    hashes.append(h)
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([ids, size, *columns, pa.array(hashes, pa.string())], ["doc_id", "size", *names, "kept_sha256"])

    return joined.select("doc_id", "size", "hash", "body", "found", "whole").mapInArrow(
        settle, f"doc_id {kinds}, size long, " + ", ".join(f"{n} long" for n in names) + ", kept_sha256 string")
