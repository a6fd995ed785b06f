"""Session helpers: building a session, the shared checkpoint folder, materialising
small or reused results, and broadcasting only what has a checked size."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measured bytes above which a "small" side is not broadcast and the join is left to a
# shuffle.  Contig, region, split and recalibration tables sit far below.
BROADCAST_BYTES = 64 << 20


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "strandline", extra: dict | None = None) -> SparkSession:
    """A session configured for this library: AQE on (coalescing, skew joins),
    UI off, UTC, Arrow for the pandas hooks."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         # a stage whose generated method exceeds the JVM's JIT limit (8000 bytes) would
         # run as interpreted bytecode; past this limit Spark uses per-operator generated
         # projections instead, which it splits into small, compiled methods
         .config("spark.sql.codegen.hugeMethodLimit", "8000")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read here.  Only when it is
    unset (local tests, the bench) is a scratch folder created and registered."""
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: no context; the folder must be configured
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise ValueError("spark.checkpoint.dir is not set")
        return d
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a "
                             "shared folder; a machine-local folder would not survive a "
                             "lost executor")
        d = tempfile.mkdtemp(prefix="strandline-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` (whatever its scheme) and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Scratch:
    """The folders written by :func:`materialize` since the scope began."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave the written table ``df`` to the enclosing scope, or for good."""
        path = getattr(df, "_written", None)
        if path not in self.paths:
            raise ValueError("only a table written in this scope can be kept")
        self.paths.remove(path)
        outer = _SCOPES.get()
        if outer[:-1]:
            outer[-2].paths.append(path)
        return df


_SCOPES: ContextVar[tuple[Scratch, ...]] = ContextVar("strandline_scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope for written intermediates: every folder that :func:`materialize` wrote in it
    is deleted when it ends, also after a failure, but for those handed to ``keep``.
    Results that still read such folders must be written (or collected) inside.  Scopes
    nest; without one, folders stay as long as the checkpoint folder does."""
    scope = Scratch()
    token = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(token)
        paths, scope.paths = scope.paths, []
        for path in paths:
            fs, p = filesystem(spark, path)
            fs.delete(p, True)


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the plan)
    and makes any non-deterministic column (partition ids) fixed data."""
    return materialize_counted(df, tag)[0]


def materialize_counted(df: DataFrame, tag: str = "t") -> tuple[DataFrame, int]:
    """:func:`materialize`, also returning the row count - observed as a metric of the
    write job itself (``Observation``), so no second job counts the table.  A stage
    retried after a lost executor can only make the count larger, which makes a size
    check stricter, never looser."""
    out, seen = _write(df, tag, rows=F.count(F.lit(1)))
    return out, int(seen["rows"])


def _write(df: DataFrame, tag: str, **metrics: Column) -> tuple[DataFrame, dict]:
    spark = df.sparkSession
    name = f"{tag}-{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_dir(spark), "strandline", name)
    if _SCOPES.get():
        # before the write: what a failed job leaves is deleted too
        _SCOPES.get()[-1].paths.append(path)
    obs = Observation(f"metrics-{name}")
    (df.observe(obs, *(c.alias(n) for n, c in metrics.items()))
     .write.mode("errorifexists").parquet(path))
    # the schema is known: reading back runs no footer-inference job
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out, obs.get


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in bytes: 16 per fixed-width value, texts by their length, nested
    values by the length of their JSON text."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 16 + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            size = size + 16
    return size


def materialize_measured(df: DataFrame, tag: str = "t") -> tuple[DataFrame, int]:
    """:func:`materialize`, also returning the table's size in bytes (:func:`row_bytes`)."""
    out, seen = _write(df, tag, size=F.sum(row_bytes(df)))
    return out, int(seen["size"] or 0)


def broadcast_checked(df: DataFrame, tag: str = "small",
                      max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after measuring its bytes.

    ``df`` is written first (one job, result kept in the checkpoint folder) and its
    size observed during that write; the broadcast hint is applied only within
    ``max_bytes``.  Beyond it the table is returned as is, and the planner shuffles
    two written tables, which AQE can split at a hot key."""
    m, size = materialize_measured(df, tag)
    return F.broadcast(m) if size <= max_bytes else m


def collect_checked(df: DataFrame, what: str, max_bytes: int = BROADCAST_BYTES) -> list:
    """Collect a table whose size is bounded by construction, failing loudly if its
    measured bytes exceed the bound.  Used only for the global recalibration table
    (read length x 128 qualities)."""
    m, size = materialize_measured(df, "collect")
    if size > max_bytes:
        raise ValueError(f"{what}: {size} bytes exceed the bound of {max_bytes}; refusing to collect")
    return m.collect()
