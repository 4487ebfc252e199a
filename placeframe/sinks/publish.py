"""Publishing a zone file by file: what differs is copied, byte for byte, under the
same object key, and every file gets a status.

Two manifests (key, size, SHA-256 of the content) are joined in full by key. The
bytes of absent and changed files go through the executors into a scratch folder
in the target; the driver then only renames them to their keys, one call for a
file (what is there is told by listings of whole folders), and the copies' digests
are compared again. A file that can't be read, staged
or renamed is ``failed``; the others still go through. A file is one row while it
is read, so files are bounded by Spark's ``spark.sql.sources.binaryFile.maxLength``
(2 GB); zones written by this library hold far smaller ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeframe.functions.columns import object_key
from placeframe.session import _folder, fresh_dir, path_exists, remove_scratch
from placeframe.sinks.writers import write_table

MANIFEST = "key string, path string, size long, digest string, tail string, lines long"
#: Renames at a time: calls to the file system, not data.
CALLS = 16
#: Files of one staging job: their paths are arguments of one scan.
STAGED = 20_000
#: More files than these are read by their folders: a path of its own is a listing of its own.
SINGLE = 200


def _literal(path: str) -> str:
    """A path that the reader's globbing takes as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _folders(paths: Iterable[str]) -> list[str]:
    """The folders of the files at ``paths``, without those below others of them."""
    out: list[str] = []
    for folder in sorted({p.rpartition("/")[0] + "/" for p in paths}):
        if not (out and folder.startswith(out[-1])):
            out.append(folder)
    return [f[:-1] for f in out]


def _there(spark: SparkSession, paths: list[str]) -> set[str]:
    """Which files there are in the folders of ``paths``, by one listing of them all; no file is opened."""
    some = [f for f in _folders(paths) if path_exists(spark, f)]
    if not some:
        return set()
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    return {r.path for r in read.load([_literal(f) for f in some]).select("path").collect()}


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files at ``paths``, which are there; what can't be read has no row."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    if len(paths) <= SINGLE:
        return read.load([_literal(p) for p in paths])
    wanted = spark.createDataFrame([(p,) for p in paths], "path string")
    return read.load([_literal(f) for f in _folders(paths)]).join(F.broadcast(wanted), "path", "left_semi")


def content_manifest(spark: SparkSession, root: str, pattern: str = "*", paths: list[str] | None = None) -> DataFrame:
    """(key, path, size, digest, tail, lines) of the files below ``root``, or of ``paths`` there: the
    SHA-256 of the whole content, its last sign and its lines; null for a file that can't be
    read. An absent root has no files, and a file without a byte is none to Spark's listing."""
    if not path_exists(spark, root) or paths == []:
        return spark.createDataFrame([], MANIFEST)
    if paths is not None:
        files = _files(spark, paths)
    else:
        read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
        files = read.option("pathGlobFilter", pattern).load(root)
    listed = files.select(object_key("path", root).alias("key"), "path", F.col("length").alias("size"))
    text = F.col("content").cast("string")
    tail = F.right(text, F.lit(1))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + (tail != "\n").cast("int")
    whole = files.select("path", F.sha2("content", 256).alias("digest"), tail.alias("tail"), lines.cast("long").alias("lines"))
    return listed.join(whole, "path", "left").select("key", "path", "size", "digest", "tail", "lines")


def diff_manifests(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both manifests joined by key: key, source_size, target_size and state: ``absent`` (from the
    target), ``changed``, ``same``, ``unreadable`` (at the source) or ``extra`` (only the target has it)."""
    s = source.select("key", "path", "tail", "lines", F.col("size").alias("source_size"), F.col("digest").alias("source_digest"))
    t = target.select("key", F.col("size").alias("target_size"), F.col("digest").alias("target_digest"))
    same = (F.col("source_size") == F.col("target_size")) & (F.col("source_digest") == F.col("target_digest"))
    state = F.when(F.col("source_size").isNull(), "extra").when(F.col("source_digest").isNull(), "unreadable")
    state = state.when(F.col("target_size").isNull(), "absent").when(same, "same").otherwise("changed")
    return s.join(t, "key", "full_outer").withColumn("state", state)


def _stage(spark: SparkSession, files: list, folder: str) -> dict[str, str]:
    """Copies files into ``folder``, one each, and returns where each key's copy lies: one with the source's digest.
    The text writer ends a record with the separator it is given, so a file is written as all but its last sign, and that."""
    there = _there(spark, [f.path for f in files])
    by_tail: dict[str, list] = {}
    for f in files:
        if f.path in there:  # what is gone by now fails alone
            by_tail.setdefault(f.tail, []).append(f)
    for k, (tail, own) in enumerate(by_tail.items()):
        for low in range(0, len(own), STAGED):
            some = own[low : low + STAGED]
            text = F.col("content").cast("string")
            bare = _files(spark, [f.path for f in some]).select(F.left(text, F.length(text) - 1).alias("value"))
            # tasks move their own files; the folder is scratch, and what it holds is read below
            bare.write.option("lineSep", tail).option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(f"{folder}/{k}-{low}")
    copies: dict[str, list[str]] = {}
    for r in content_manifest(spark, folder, "part-*").select("path", "digest").collect():
        copies.setdefault(r.digest, []).append(r.path)
    return {f.key: copies[f.source_digest].pop() for f in files if copies.get(f.source_digest)}


def _place(spark: SparkSession, target: str, files: list, staged: dict[str, str]) -> list[str]:
    """Renames the staged copies to their keys, over what is there, and returns the paths that are
    there then. What fails stays as it was; the check that follows says so."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, root = _folder(spark, target)
    root = fs.makeQualified(root)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    top = root.toString().rstrip("/")
    for folder in sorted({f"{top}/{f.key}".rpartition("/")[0] for f in files}):
        try:
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
        except Py4JJavaError:
            continue  # its files fail below

    def one(f) -> None:
        copy, to = jvm.org.apache.hadoop.fs.Path(staged[f.key]), jvm.org.apache.hadoop.fs.Path(f"{top}/{f.key}")
        try:
            # the rename over a file is the slow one on some file systems
            if fs.exists(to) or not fs.rename(copy, to):
                context.rename(copy, to, over)
        except Py4JJavaError:
            pass

    with ThreadPoolExecutor(CALLS) as pool:
        list(pool.map(one, [f for f in files if f.key in staged]))
    paths = [f"{top}/{f.key}" for f in files]
    there = _there(spark, paths)
    return [p for p in paths if p in there]


def publish_files(spark: SparkSession, source_root: str, target_root: str, pattern: str = "*.{json,txt}") -> DataFrame:
    """Brings the target up to date with the source's files. Returns a row for each of
    these: key, size, lines, state before (absent, changed, same, unreadable) and status: ``uploaded``,
    ``unchanged`` or ``failed``. Files that only the target has stay.

    The driver holds the paths of the files to copy, as it holds the listing of any scan.
    """
    scratch = fresh_dir(spark, "publish")
    source = content_manifest(spark, source_root, pattern)
    diff = write_table(diff_manifests(source, content_manifest(spark, target_root, pattern)), f"{scratch}/diff").filter("state <> 'extra'")
    todo = diff.filter("state in ('absent', 'changed')").select("key", "path", "tail", "source_digest").collect()
    # on the target's own file system, where a rename moves no data
    beside = f"{target_root.rstrip('/')}/_staging-{scratch.rsplit('-', 1)[1]}"
    copied = _place(spark, target_root, todo, _stage(spark, todo, beside))
    fs, where = _folder(spark, beside)
    fs.delete(where, True)
    now = content_manifest(spark, target_root, paths=copied).select("key", F.col("digest").alias("copy_digest"))
    status = F.when(F.col("state") == "same", "unchanged").when(F.col("copy_digest") == F.col("source_digest"), "uploaded").otherwise("failed")
    report = diff.join(now, "key", "left").select("key", F.col("source_size").alias("size"), "lines", "state", status.alias("status"))
    out = write_table(report, f"{fresh_dir(spark, 'published')}/report")
    remove_scratch(spark, scratch)
    return out


def file_counts(report: DataFrame) -> dict[str, int]:
    """How many files were uploaded, unchanged and failed."""
    counts = {r.status: r.n for r in report.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {s: counts.get(s, 0) for s in ("uploaded", "unchanged", "failed")}


def assert_files_published(report: DataFrame, sample: int = 20) -> DataFrame:
    """Fails when a file failed; at most ``sample`` of them come to the driver, for the message."""
    bad = report.filter("status = 'failed'").select("key").limit(sample).collect()
    if bad:
        raise RuntimeError(f"{len(bad)}+ file(s) failed to upload, e.g. {[r.key for r in bad[:3]]}")
    return report
