"""Shared pieces of the text operators: inputs, staged tables, native word rules."""
from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import new_work_dir
from ..sources.io import ship_package

SPACES = " \t\n\x0b\x0c\r"                      # the characters \x20 and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_BYTES = 8 << 20                           # text handed to a Python worker at a time
SMALL_BATCH = 2 << 20                           # where workers of several stages share an executor


def prepare(spark: SparkSession, batch: int = BATCH_BYTES) -> None:
    """Make this package importable in Python workers, and bound their batches by bytes
    (Spark's own bound is 10,000 rows or 64 MiB, held in the JVM and in the worker)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch))


CACHES: list = []             # dictionaries that modules keep in Python workers, emptied at a task's end


def tidy(run):
    """An Arrow function that gives back what its worker kept for it when the task ends.

    Workers are reused for later tasks and other stages; without this, each keeps its
    largest tables and the C library its largest heap for the rest of the job."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for cache in CACHES:
                cache.clear()
            _release()
    return wrapped


def _release() -> None:
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                       # another C library
        pass


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_go(spark: SparkSession):
    """Queries run inside delete their shuffle files when they end (a lost one is made again)."""
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if old is None else spark.conf.set(SHUFFLE_CLEANUP, old)


class Workspace:
    """Tables written to the shared folder to cut lineage.

    Every intermediate result that several later jobs read is written once and
    reread, so a lost executor costs a reread and never a changed answer.
    ``finish`` stages the result and deletes everything else."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def stage(self, df: DataFrame, name: str, free: bool = True, by: str | None = None) -> DataFrame:
        """``df`` written and read again, in folders by the values of ``by`` if given.  The shuffle
        files of the write go when it ends.  ``free`` asks the driver to collect what it no longer
        refers to: Spark deletes other finished jobs' shuffle files only then, and a driver whose
        executors do the work seldom collects by itself."""
        path = new_work_dir(self.spark, f"{self.name}-{name}")
        with _shuffles_go(self.spark):
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        if free:
            self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def stage_rounds(self, rounds: int, make, name: str) -> DataFrame:
        """The union of ``make(0)`` .. ``make(rounds - 1)``, staged one after another: the disk
        holds the shuffle files of one of them at a time.  ``drop`` takes it as a whole."""
        parts = [self.stage(make(r), f"{name}-{r}") for r in range(rounds)]
        out = reduce(DataFrame.unionAll, parts)
        self.paths[id(out)] = (out, *(self.paths.pop(id(x))[1] for x in parts))
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            for path in self.paths.pop(id(df), ())[1:]:
                self._delete(path)

    def finish(self, df: DataFrame) -> DataFrame:
        old = list(self.paths.values())
        out = self.stage(df, "result")
        for path in (p for _, *paths in old for p in paths):
            self._delete(path)
        self.paths = {}
        return out

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value, body):
    """``body(value)`` with ``value`` evaluated once (a one-element lambda binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(c) -> F.Column:
    """Lower-case A-Z only; null becomes the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(F.coalesce(c, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def space_words(c) -> F.Column:
    """Words between ASCII white space, as an array; null text has none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(WORD), F.lit(0))


def with_fields(schema: StructType, *fields) -> StructType:
    """A copy of ``schema`` with further (name, type) fields."""
    out = StructType(list(schema.fields))
    for name, kind in fields:
        out = out.add(name, kind)
    return out


def free_name(columns, name: str) -> str:
    """``name``, with underscores added until no column of ``columns`` has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
