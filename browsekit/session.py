"""Session settings every job relies on."""

from __future__ import annotations

import itertools
import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on (UTC clock, ANSI casts) and the runtime
# re-planning the jobs are written for (AQE coalescing, skew-join split,
# runtime broadcast of sides that turn out small).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle partitions to the advisory size at most, and below it (down to 1 MB)
    # as long as cores would be idle; rows sorted or hashed in memory take many times their
    # compressed shuffle size
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # a join side is broadcast only when its measured size is under this; never by the
    # planner's estimate, which knows compressed file sizes and not what explode adds
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings the operators assume."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "browsekit") -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a session on a
    local master (tests) gets a fresh scratch folder; on any other master this is an
    error, since executors would each write to a disk of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="browsekit-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def stage_root(spark: SparkSession) -> str:
    """Folder of this application's stage tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/browsekit-{spark.sparkContext.applicationId}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder, on any file system Spark can reach; False if there was none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place in one step: readers see the old text or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    made = jvm.org.apache.hadoop.fs.Path(f"{path}.{os.getpid()}-{next(_counter)}")
    out = made.getFileSystem(conf).create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.getFileSystem(conf).getUri(), conf).rename(
        made.getFileSystem(conf).makeQualified(made), target.getFileSystem(conf).makeQualified(target), options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    if not path_exists(spark, path):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def expire_stage_tables(spark: SparkSession) -> bool:
    """Remove this application's stage tables (after a run's outputs are written); frames
    that still read them can no longer be computed."""
    return delete_path(spark, stage_root(spark))


@contextmanager
def stage_scope(spark: SparkSession):
    """Stage tables written inside, also by the threads of a job, are removed at its end, whether
    it succeeds or not; those written before or beside it stay.  Scopes of one application may
    nest but not overlap."""
    with _scope_lock:
        _scopes.append(f"scope-{os.getpid()}-{next(_counter)}")
        here = f"{stage_root(spark)}/{'/'.join(_scopes)}"
    try:
        yield here
    finally:
        with _scope_lock:
            _scopes.pop()
        delete_path(spark, here)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A per-call table location under the shared checkpoint folder, grouped
    by application (and by scope) so one run's stage tables can be expired together."""
    return "/".join([stage_root(spark), *_scopes, f"{name}-{os.getpid()}-{next(_counter)}"])


_scopes: list[str] = []
_scope_lock = threading.Lock()
# called with every frame that is about to be written as a stage table (plan tests)
stage_observers: list = []
_counter = itertools.count(1)   # next() on a count is atomic: safe from job threads


def materialize(df):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    continue from the written table: cuts the lineage at a stage boundary
    (a lost executor recomputes from here), keeps later plans small, and
    the re-read is a columnar scan with pruning, pushdown and real size
    statistics for AQE's join choices."""
    for see in stage_observers:
        see(df)
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_many(*dfs):
    """``materialize`` for independent frames, submitted as concurrent Spark
    jobs (one driver thread each) so small stages share the cluster instead
    of queueing behind one another."""
    from concurrent.futures import ThreadPoolExecutor

    if len(dfs) < 2:
        return [materialize(d) for d in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(materialize, dfs))
