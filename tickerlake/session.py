"""Session helpers: sane defaults for bar workloads and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on: UTC so dates and naive timestamps do not
# shift, AQE so shuffle partitions coalesce and skewed joins split at runtime.
# hugeMethodLimit 8000: HotSpot never JIT-compiles a method above 8000
# bytecodes, so a larger whole-stage method (e.g. staging predicates inlined
# over computed columns) would run interpreted, ~10x slower; at 8000 Spark
# splits that stage instead.
SESSION_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tickerlake",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass no ``master``; the launcher decides. ``spark.checkpoint.dir``
    is taken from the cluster configuration and only filled in when unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def tuned(spark: SparkSession) -> SparkSession:
    """``spark`` with the method limit of ``SESSION_DEFAULTS``, for sessions that
    others built: at Spark's own, the staging filters over computed columns
    run interpreted. A limit that the session was given stays."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, SESSION_DEFAULTS[METHOD_LIMIT])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Raises when the cluster names none: a machine-local temporary folder does
    not survive the loss of an executor, so the library never invents one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Make ``spark.checkpoint.dir`` effective for ``DataFrame.checkpoint``.

    Uses the session's setting. Only a caller that knows it runs locally
    (tests) passes ``fallback``; with neither, this raises rather than
    invent a machine-local folder that a lost executor could not read.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or fallback
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tickerlake/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` once as Parquet in the shared checkpoint folder and
    read it back (never a local checkpoint, never a machine-local path).

    Used where several outputs share one expensive input: a lost executor
    re-reads the written files instead of recomputing from raw data. A
    written table is computed once, whereas ``checkpoint()`` of an unpersisted
    DataFrame runs its plan a second time to write the checkpoint.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that nothing reads any more."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def together(*tasks) -> list:
    """Run callables that start independent Spark jobs side by side, so that one's
    last tasks overlap the other's first; raises the first failure after all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


class Cut:
    """``with Cut(df) as rows``: ``df`` written once, read back as ``rows``, and
    the files deleted at the end of the block."""

    def __init__(self, df: DataFrame, name: str = "cut"):
        self.df, self.name = df, name

    def __enter__(self) -> DataFrame:
        spark = self.df.sparkSession
        ensure_checkpoint_dir(spark)
        self.path = scratch_path(spark, self.name)
        self.df.write.parquet(self.path)
        return spark.read.schema(self.df.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        remove(self.df.sparkSession, self.path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, resolved like Spark resolves it (default FS)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
