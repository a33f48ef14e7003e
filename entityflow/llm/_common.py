"""Shared plumbing of the training-data operators.

Every operator takes the names of its id and text columns, reads only those
(under private names, so extra or clashing column names cannot interfere) and
treats a null text as empty unless its docstring says otherwise.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to a worker function at once: bounds the Python objects alive in a task.
SLICE_ROWS = 512


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def release() -> None:
    """Give memory that a finished task freed back to the system: worker processes are reused, so it would add up."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Clearing functions of the caches that modules keep in a worker, by module; the module that ran last.
CACHES: dict[str, list[Callable]] = {}
_LAST = [""]


def begin(owner: str) -> None:
    """Reused workers drop the caches of the operator that ran before."""
    if _LAST[0] != owner:
        for name, clear in CACHES.items():
            if name != owner:
                for f in clear:
                    f()
        release()
        _LAST[0] = owner


def map_batches(df: DataFrame, run: Callable, schema, owner: str | None = None) -> DataFrame:
    """mapInArrow that releases memory at the end of each task."""
    name = owner or run.__module__

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(name)
        yield from run(batches)
        release()

    return df.mapInArrow(task, schema)


def map_rows(df: DataFrame, columns: list[Column], make: Callable[[], Callable], schema: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Arrow map without a shuffle. ``make()`` runs once per task and returns f(*lists) -> list of output columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                cols = f(*[c.to_pylist() for c in part.columns])
                if cols is not None:
                    yield _batch(cols, out)
        if (end := getattr(f, "end", None)) is not None and (cols := end()) is not None:
            yield _batch(cols, out)

    return map_batches(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), run, schema, make.__module__)


def _batch(cols, out: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, out)], schema=out)


def map_whole(df: DataFrame, run: Callable) -> DataFrame:
    """map_batches over all columns with the schema kept, whatever the columns' names are (dots, repeats)."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return map_batches(plain, run, plain.schema, run.__module__).toDF(*df.columns)


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="entityflow-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df to the shared folder and read it again. The files go when the application ends or at ``drop``."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/entityflow/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def drop(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no result reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(t._scratch)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class RaggedMemo(dict):
    """Words to int sequences, remembered up to a bound of words.

    ``encode_many(words)`` gives (flat int32 ids, ids of each word); ``lookup`` turns a list of words into flat
    ids and lengths with array gathers only. Beyond ``most`` words the memo starts anew before the next lookup.
    """

    def __init__(self, encode_many: Callable, most: int):
        import numpy as np

        super().__init__()
        self.np, self.encode_many, self.most = np, encode_many, most
        self._reset()

    def _reset(self) -> None:
        np = self.np
        self.clear()
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.lens = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.n, self.pending = 0, []

    def __missing__(self, word: str) -> int:
        self.pending.append(word)
        i = self[word] = self.n + len(self.pending) - 1
        return i

    def _grown(self, a, need: int):
        if need <= len(a):
            return a
        out = self.np.zeros(max(need, 2 * len(a)), a.dtype)
        out[: len(a)] = a
        return out

    def lookup(self, words: list[str]):
        np = self.np
        if self.n > self.most:
            self._reset()
        index = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.pending:
            flat, lens = self.encode_many(self.pending)
            m, used = self.n + len(self.pending), self.used + len(flat)
            self.pool, self.starts, self.lens = self._grown(self.pool, used), self._grown(self.starts, m), self._grown(self.lens, m)
            self.pool[self.used : used] = flat
            self.lens[self.n : m] = lens
            self.starts[self.n : m] = self.used + np.cumsum(lens) - lens
            self.n, self.used = m, used
            self.pending = []
        lens = self.lens[index]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[index] - (ends - lens), lens)
        at += np.arange(total)
        return self.pool[at], lens

    def texts(self, words_of: list[list[str]]):
        """Flat ids of several texts and where each text's ids end."""
        np = self.np
        flat, lens = self.lookup([w for ws in words_of for w in ws])
        ends = np.concatenate([[0], np.cumsum(lens)])
        return flat, ends[np.cumsum(np.fromiter(map(len, words_of), np.int64, len(words_of)))]
