"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on; AQE re-plans joins (broadcast after a
# measured small shuffle), coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # no per-call Python stack capture while building plans (debug aid only)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "placeframe",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context handle (e.g. Spark Connect)
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset (local tests) do we create a
    private one. Never falls back to a machine-local folder on a cluster.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if d:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="placeframe-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(d)
    else:
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables (beside the checkpoints)."""
    d = ensure_checkpoint_dir(spark)
    # getCheckpointDir() appends a per-application uuid; use the configured root
    configured = spark.conf.get("spark.checkpoint.dir", None) or d
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, never-reused folder under the shared root (one per call)."""
    return f"{shared_root(spark)}/placeframe/{tag}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, for any Hadoop URI."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _folder(spark, path)
    return fs.exists(where)


def replace_file(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file over another of the same file system, in one step where it has one."""
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fs, where = _folder(spark, to)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(path), fs.makeQualified(where), over)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it isn't there)."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    return [x.getPath().getName() for x in fs.listStatus(where) if x.isDirectory()]


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``fresh_dir`` named, once its job has no more use for it."""
    if "/placeframe/" not in path or not path.startswith(shared_root(spark)):
        raise ValueError(f"{path} is no scratch folder of this session")
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Scan one source table; declared tables skip schema inference."""
    from placeframe.schemas import SOURCE_TABLES

    r = spark.read
    if name in SOURCE_TABLES:
        r = r.schema(SOURCE_TABLES[name])
    return r.parquet(table_path(sf_dir, name))
