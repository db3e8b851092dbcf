"""Session construction and the shared scratch location.

On a cluster the session already carries ``spark.checkpoint.dir`` (a shared folder);
we only read it.  A local folder is chosen only when the setting is absent, which is
the case for tests and local benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Inference is a side effect: never run a batch twice on purpose.
    "spark.speculation": "false",
    # Python's json keeps the last of duplicate object keys; so does VARIANT with this
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str | None = None, app: str = "glossa",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (cluster jobs get theirs from spark-submit)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("GLOSSA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a local one only if none is set."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or \
                spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="glossa-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location (recorded in the
    innermost :func:`scratch_scope`, if any)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/glossa/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on exit, the scratch folders created inside the block.

    Intermediate tables (ordered units, requests, replies, wave partitions) are about
    as large as the translated text; a job that has committed its results (appended
    to the log) removes them so the shared folder does not grow with every run.  Only
    the folders this block created are touched, through the Hadoop FileSystem of the
    shared folder.  Yields the list of created paths.
    """
    created: list[str] = []
    _SCOPES.append(created)
    try:
        yield created
    finally:
        _SCOPES.pop()
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in created:
            path = jvm.org.apache.hadoop.fs.Path(p)
            fs = path.getFileSystem(conf)
            if fs.exists(path):
                fs.delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the plans that are run inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Rows of texts that go to a Python worker at once.
ROWS_AT_ONCE = 512
_ROWS_AT_ONCE_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows_at_once(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session to ROWS_AT_ONCE rows; a smaller bound stays.

    Spark's default of 10,000 rows holds all texts of a task at once, in the executor's
    native memory and again in Python.  Plans read the setting when they run, which for a
    returned DataFrame is after the operator, so it stays set."""
    now = int(spark.conf.get(_ROWS_AT_ONCE_CONF))
    if now <= 0 or now > ROWS_AT_ONCE:
        spark.conf.set(_ROWS_AT_ONCE_CONF, str(ROWS_AT_ONCE))


#: Codec of tables that hold texts, about half as large as with Spark's default.
TEXT_CODEC = "zstd"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage so that (a) side effects upstream (paid inference calls) are never
    recomputed, and (b) columns derived from partition layout (``spark_partition_id``)
    stay fixed for every later pass.  Survives executor loss: the data lives in the
    shared folder, not in executor memory.

    ``group_rows`` is for wide rows: Parquet row groups of at most as many.  A scan decodes
    4,096 rows at once, but never beyond a row group, whatever session reads them later.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", str(group_rows))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop FileSystem of ``path``, its Path): local, relative or in any store."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system, not on the driver's disk."""
    fs, target = file_system(spark, path)
    return bool(fs.exists(target))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder that holds at least one Parquet file (a table whose
    first append has not been committed is no table yet)."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file under its final name in one step: written aside, then renamed."""
    fs, target = file_system(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"could not publish {path}")


def balance(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A Parquet file with one row group is read by one task; per-row CPU work after the
    scan (JSON parsing, text building) would then run single-threaded.  Only then is
    the input redistributed round-robin; a large input (one split per row group and
    128 MB) already has many partitions and is returned unchanged, with no shuffle.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


_SHIPPED_FLAG = "spark.glossa.pyfiles.shipped"


def ship_package(spark: SparkSession) -> None:
    """Make ``glossa`` importable on the executors (what ``--py-files`` does).

    Pandas UDFs and ``mapInPandas`` functions defined in the package are pickled by
    reference, so Python workers must be able to import it wherever the driver was
    started.  The package is zipped once per application and added with
    ``addPyFile``; Spark distributes it to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.getConf().get(_SHIPPED_FLAG, "") == "1" or getattr(sc, "_glossa_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    ckpt = ensure_checkpoint_dir(spark)
    local_ckpt = ckpt[len("file:"):] if ckpt.startswith("file:") else ckpt
    base = local_ckpt if local_ckpt.startswith("/") else tempfile.mkdtemp(prefix="glossa-py-")
    os.makedirs(base, exist_ok=True)
    target = os.path.join(base, f"glossa-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    sc._glossa_shipped = True
