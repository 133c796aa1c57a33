"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    """Local session for tests and the bench; a cluster session comes from the caller."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, the bench) may go without one and gets a private folder;
    on a cluster a machine-local folder would lose files, so the setting is required.
    """
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, path)
    # SparkContext.setCheckpointDir is what DataFrame.checkpoint() uses.
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for tables the library writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry/{name}"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the queries made inside."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


_scopes: list[list[DataFrame]] = []


def kept(df: DataFrame) -> DataFrame:
    """``df`` checkpointed.  The shuffles that made it go from the disks once it is written, not
    when the driver's garbage collector happens to run."""
    ensure_checkpoint_dir(df.sparkSession)
    with setting(df.sparkSession, FREE_SHUFFLES, "true"):
        out = df.select("*").checkpoint()  # a query takes the setting when it is made
    out.kept_at = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    if _scopes:
        _scopes[-1].append(out)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``kept`` as compressed Parquet, for tables of the size of the input: some a quarter of a
    checkpoint's bytes.  How the rows are dealt and sorted is lost."""
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    with setting(df.sparkSession, FREE_SHUFFLES, "true"):
        df.select("*").write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def freed(*frames: DataFrame | None) -> None:
    """Removes the files of tables that were ``kept`` or ``stored`` and that nothing reads any more."""
    for df in frames:
        if df is not None:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.kept_at)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextlib.contextmanager
def last_kept() -> Iterator[None]:
    """Of the tables ``kept`` inside, the last one stays and the others are removed."""
    _scopes.append([])
    try:
        yield
    except BaseException:
        _scopes.pop()
        raise
    mine = _scopes.pop()
    freed(*mine[:-1])
    if _scopes:
        _scopes[-1] += mine[-1:]
