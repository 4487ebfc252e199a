"""Publishing a set of tables at once: each run writes a version folder of its own, and
a pointer is replaced when all tables are written.

A reader takes the pointer's version, so it sees the old tables or the new ones, all of
one run, and never a half; a run that fails before the pointer is replaced leaves
what readers see as it was. The last ``keep`` versions stay for readers that are still at
work. Catalog tables, if asked for, are repointed to the new version's folders.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from placeframe.session import _folder, folder_names, path_exists, replace_file
from placeframe.sinks.writers import write_table

POINTER = "current"
VERSION = "version-"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that the pointer names, if there is one."""
    path = f"{root.rstrip('/')}/{POINTER}"
    if not path_exists(spark, path):
        return None
    fs, where = _folder(spark, path)
    return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(where), "UTF-8").strip()


def publish_version(tables: dict[str, DataFrame], root: str, keep: int = 2, database: str | None = None) -> str:
    """Writes the tables as a new version below ``root``, points readers to it and removes
    versions but the last ``keep`` (the new one counts). Returns the version."""
    if not tables or keep < 1:
        raise ValueError("a version needs a table, and one version is kept at least")
    root, spark = root.rstrip("/"), next(iter(tables.values())).sparkSession
    version = f"{VERSION}{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    written = {name: write_table(df, f"{root}/{version}/{name}") for name, df in tables.items()}
    fs, new = _folder(spark, f"{root}/{POINTER}.{version}")
    out = fs.create(new, True)
    out.writeBytes(version)
    out.close()
    replace_file(spark, new.toString(), f"{root}/{POINTER}")
    for name, df in written.items() if database else ():
        _repoint(spark, f"{database}.{name}", df, f"{root}/{version}/{name}")
    for old in sorted((n for n in folder_names(spark, root) if n.startswith(VERSION) and n < version), reverse=True)[keep - 1 :]:
        fs.delete(_folder(spark, f"{root}/{old}")[1], True)
    return version


def _repoint(spark: SparkSession, table: str, df: DataFrame, path: str) -> None:
    if spark.catalog.tableExists(table):
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def read_version(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the current version, or of the one given. A reader of several tables takes
    ``current_version`` once and passes it, so that they are of one run."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{version}/{name}")
