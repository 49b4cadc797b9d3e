"""Session settings and the few helpers that touch the driver or shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "tidemark", master: str | None = None, **settings) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays as Spark sets it.

    The shuffle width is left to adaptive coalescing unless the caller passes
    ``spark.sql.shuffle.partitions`` (small local runs do).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Folders made for sessions that name none, and the scratch tables of this process.
_LOCAL_ROOTS: dict[str, str] = {}
_WRITTEN: list[str] = []
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)

#: Makes Spark delete the shuffle files of a query when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A session on one machine that names none (unit tests, a laptop) gets a
    temporary folder.  On a cluster that would lose data, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared root, known to :func:`drop_scratch`."""
    path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables whose paths are made inside are deleted at the end, also after an error.

    What has to outlive the scope is written to a path made before it (``durable(df, path)``).
    Scopes nest; each thread has its own.
    """
    made: list[str] = []
    outer = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        drop_scratch(spark, [p for p in made if p in _WRITTEN])


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch tables that this process wrote: all, or the given ones.

    Call it when no DataFrame that reads them is needed any more.  Paths that
    were not made by :func:`scratch_path` are refused.
    """
    for path in list(_WRITTEN) if paths is None else paths:
        _WRITTEN.remove(path)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def durable(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    Used for tables that several jobs read: lineage is cut at reliable storage,
    so a lost executor costs a re-read and not a re-computation, and later jobs
    read only the columns they need.  The shuffle files of the write are
    released at its end, as nothing refers to them any more.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "table")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def durable_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`durable`, and aggregates over all rows that are observed while they are written."""
    seen = Observation()
    return durable(df.observe(seen, *[e.alias(n) for n, e in metrics.items()])), seen.get


def literal_frame(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A DataFrame of a few driver-side values, built from SQL literals."""
    def as_struct(values) -> Column:
        return F.struct(
            *[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, columns.items())]
        )

    one = spark.range(1, numPartitions=1)
    if not rows:
        return one.select(*[F.lit(None).cast(k).alias(n) for n, k in columns.items()]).where("false")
    return one.select(F.inline(F.array(*[as_struct(r) for r in rows])))
