"""Tables that are replaced as a whole (SC3), with the counts taken while they are written (SC4).

A table's folder holds one folder a version and a list of commits.  A load writes its rows to a new version and
then adds a commit, one small file that is created only where none of its number exists.  Readers take the version
of the last commit, so they stay on the old one until the new is whole; a load that is killed leaves the table
as it was, and it can be run again.  Nothing is renamed, so this holds on object stores too.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
#: Versions without a commit are removed when they are this old, which no running load is.
STALE_HOURS = 48
#: Partition folders of a table that a task writes side by side; rows of further ones are sorted first.
OPEN_FOLDERS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _read_json(spark: SparkSession, file: str) -> dict | None:
    path, fs = _path(spark, file)
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None  # a commit that is still being written does not count


def commits(spark: SparkSession, root: str) -> list[dict]:
    """The commits of a table, oldest first: number, version, rows, and what the writer noted."""
    found = []
    for name in _listed(spark, f"{root.rstrip('/')}/{COMMITS}"):
        if name.isdigit() and (entry := _read_json(spark, f"{root.rstrip('/')}/{COMMITS}/{name}")):
            found.append({"commit": int(name), **entry})
    return found


def _commit(spark: SparkSession, root: str, entry: dict) -> int:
    from py4j.protocol import Py4JJavaError

    names = [int(n) for n in _listed(spark, f"{root}/{COMMITS}") if n.isdigit()]
    number = max(names, default=0) + 1
    while True:
        path, fs = _path(spark, root, COMMITS, f"{number:012d}")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            number += 1  # another load was faster; this one replaces its table
            continue
        out.write(bytearray((json.dumps(entry) + "\n").encode()))
        out.close()
        return number


def replace_table(df: DataFrame, root: str, partition_by: list[str] | None = None, note: dict | None = None) -> int:
    """Write ``df`` as the table's next version and return its rows, counted by the write itself.

    A task keeps the files of up to OPEN_FOLDERS partition folders open, so its rows are not sorted (and spilled) by folder.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    version, seen = f"v-{uuid.uuid4().hex}", Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_WRITERS, "0")
    try:
        if partition_by and before == "0":
            spark.conf.set(_WRITERS, str(OPEN_FOLDERS))
        writer.parquet(f"{root}/{version}")
    finally:
        spark.conf.set(_WRITERS, before)
    rows = int(seen.get["rows"])
    _commit(spark, root, {"version": version, "rows": rows, **(note or {})})
    return rows


def is_versioned(spark: SparkSession, root: str) -> bool:
    return bool(_listed(spark, f"{root.rstrip('/')}/{COMMITS}"))


def read_table(spark: SparkSession, root: str, commit: int | None = None) -> DataFrame:
    """The table as of its last commit (or of ``commit``); a plain Parquet folder is read as it is."""
    root = root.rstrip("/")
    if not is_versioned(spark, root):
        return spark.read.parquet(root)
    found = [c for c in commits(spark, root) if commit in (None, c["commit"])]
    if not found:
        raise ValueError(f"{root} has no commit {commit if commit is not None else 'that is whole'}")
    return spark.read.parquet(f"{root}/{found[-1]['version']}")


def row_counts(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """SC4: ``(table_name, row_count)`` of the tables below ``root``, from their commits: no table is scanned."""
    rows = [(t, commits(spark, f"{root.rstrip('/')}/{t}")[-1]["rows"]) for t in tables]
    return spark.createDataFrame(rows, "table_name string, row_count long")


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the versions of all but the last ``keep`` commits, and stale ones of loads that never finished."""
    root, gone = root.rstrip("/"), []
    done = commits(spark, root)
    stays = {c["version"] for c in done[-keep:]} if keep else set()
    known = {c["version"] for c in done}
    for name in _listed(spark, root):
        path, fs = _path(spark, root, name)
        stale = fs.getFileStatus(path).getModificationTime() < (time.time() - STALE_HOURS * 3600) * 1000
        if name.startswith("v-") and name not in stays and (name in known or stale):
            fs.delete(path, True)
            gone.append(name)
    return gone
