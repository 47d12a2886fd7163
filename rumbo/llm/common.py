"""Helpers shared by the operators of this subpackage.

* :func:`store` writes a frame into the shared folder named by
  ``spark.checkpoint.dir`` and reads it back: the lineage is cut by files that
  every executor sees and that survive the loss of the one that wrote them, and
  the planner knows their true size.
* :class:`Text` is a numpy view of an Arrow string array (one byte buffer and
  the offsets of its texts), with word and line segmentation and segment
  hashes computed for a whole batch at once.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A word is a run of bytes other than space and the controls TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 20          # text bytes handled by one numpy step inside a task
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_deployed: set[str] = set()


def deploy(spark: SparkSession | None = None) -> None:
    """Let Spark send this package's code to the Python workers, once for each application.

    Texts are long, so Arrow batches are cut to ``BATCH_ROWS`` rows unless the
    session asks for fewer: a worker's memory follows its batches.
    """
    spark = spark or SparkSession.active()
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _deployed:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rumbo-code-")) / "rumbo_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _deployed.add(sc.applicationId)


try:
    _malloc_trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):            # another C library: nothing to hand back
    _malloc_trim = None


def trim() -> None:
    """Hand memory that a batch has used back to the system.

    Spark keeps idle Python workers for the next stage; without this each of
    them keeps the most that any batch of any stage has needed.
    """
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder, removed when the application ends."""
    deploy(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads the files."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`store` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of the column's text, modulo ``n`` (null counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_pow = np.ones(1, np.uint64)
_pow_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept for the next call up to one slice's length."""
    global _pow, _pow_inv
    if len(_pow) >= n:
        return _pow, _pow_inv
    size = max(n, SLICE_BYTES + 1)
    with np.errstate(over="ignore"):
        p = np.full(size, _BASE, np.uint64)
        q = np.full(size, _BASE_INV, np.uint64)
        p[0] = q[0] = 1
        np.cumprod(p, out=p)
        np.cumprod(q, out=q)
    if size <= 4 * SLICE_BYTES:
        _pow, _pow_inv = p, q
    return p, q


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and xor-shift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Text:
    """Texts of a batch as one byte array; null counts as the empty text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1

    @classmethod
    def of(cls, array) -> Text:
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        if array.null_count:
            array = array.fill_null("")
        wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
        _, off, data = array.buffers()
        offsets = np.frombuffer(off, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = int(offsets[0]) if len(offsets) else 0
        last = int(offsets[-1]) if len(offsets) else 0
        return cls(raw[first:last], offsets.astype(np.int64) - first)

    def slices(self, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Text]]:
        """(first, last, texts) with at most ``limit`` bytes each, or one longer text."""
        i = 0
        while i < self.n:
            j = int(np.searchsorted(self.offsets, self.offsets[i] + limit, "right")) - 1
            j = min(max(j, i + 1), self.n)
            a, b = self.offsets[i], self.offsets[j]
            yield i, j, Text(self.data[a:b], self.offsets[i:j + 1] - a)
            i = j

    def _runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each run of True bytes; runs end at text borders."""
        n = len(inside)
        if n == 0:
            e = np.zeros(0, np.int64)
            return e, e, e
        border = np.zeros(n + 1, bool)
        border[self.offsets[self.offsets <= n]] = True
        prev = np.empty(n, bool)
        prev[0], prev[1:] = False, inside[:-1]
        starts = np.flatnonzero(inside & (~prev | border[:n]))
        nxt = np.empty(n, bool)
        nxt[-1], nxt[:-1] = False, inside[1:]
        ends = np.flatnonzero(inside & (~nxt | border[1:])) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._runs(~_IS_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Non-empty lines."""
        return self._runs(self.data != 0x0A)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte segment (polynomial over prefix sums, then mixed with its length)."""
        p, q = _powers(len(self.data) + 1)
        with np.errstate(over="ignore"):
            prefix = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * p[:len(self.data)], out=prefix[1:])
            h = (prefix[ends] - prefix[starts]) * q[starts]
            return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def per_text(self, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, weights=weights, minlength=self.n)
