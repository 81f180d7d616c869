"""Table writers: overwrite, create-as-select, versioned snapshots, row counts.

Writes are the lineage cut of a batch run: each layer is materialised once
and read back by its consumers, instead of being recomputed per action.
Paths are expected on shared storage (the session's checkpoint root or a
warehouse location), never a machine-local folder.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Overwrite (or append) a Parquet table; optional partition columns."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Drop-and-create a catalog table from ``df``; returns the new table."""
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def ctas(spark: SparkSession, df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
    """CREATE TABLE name [COMMENT] AS SELECT ... (fails if it exists)."""
    view = f"__ctas_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(view)
    c = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE TABLE {name} USING parquet{c} AS SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table, as a union of global counts."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def stored_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, row_count) of written Parquet tables.  A count without any
    column reads the row counts of the file footers: no data column is scanned."""
    return table_counts({name: spark.read.parquet(path) for name, path in paths.items()})


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_table(spark: SparkSession, path: str, name: str, comment: str, properties: dict[str, str]) -> None:
    """An external catalog table over written Parquet, with its comment and
    properties; an existing name is pointed to ``path`` and described anew."""
    spark.read.parquet(path)  # fails before the catalog is changed
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)} "
              f"COMMENT {_quoted(comment)} TBLPROPERTIES ({listed})")
    if any(st.isDirectory() and "=" in st.getPath().getName() for st in _listed(spark, path)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _listed(spark: SparkSession, path: str) -> list:
    fs, p, _ = _fs_and_path(spark, path)
    return list(fs.listStatus(p))


# ---------------------------------------------------------------------------
# Versioned snapshots (a keyed table without MERGE support)
# ---------------------------------------------------------------------------
# Layout: <root>/v=<000000000001>-<attempt>/part-*.parquet, and one marker
# <root>/_tags/v=<000000000001> that names the attempt's folder and its writer.
# A version is visible once its marker is written; markers are created
# exclusively, so of two writers building on one version the second gets
# ``VersionTaken`` and builds again on the first one's result
# (``snapshot_update``).  A writer looks again after the create: if a version
# it did not build on is there (markers of expired versions are gone, so a late
# writer's number may be free again), it withdraws its own.  Only the unbroken
# run of markers up to the newest counts, and an empty marker (its writer died
# inside the create) is stepped over once it is old.  Nothing is overwritten in
# place, so a crash at any point leaves the previous version readable, and a
# plan may read version n while writing n + 1.  Listing uses the Hadoop FileSystem of the path; only
# names and markers are read on the driver.  The exclusive create is atomic on
# HDFS and on stores with conditional writes.

_VERSION_PREFIX = "v="
PUBLISH_TRIES = 20
RETRY_SECONDS = 0.2
STALE_SECONDS = 60.0


class VersionTaken(RuntimeError):
    """Another writer published the version first."""


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _markers(spark: SparkSession, root: str) -> dict[int, tuple[int, float]]:
    """(bytes, age in seconds) of every version's marker."""
    fs, p, jvm = _fs_and_path(spark, os.path.join(root, "_tags"))
    if not fs.exists(p):
        return {}
    now = time.time()
    found = [(st.getPath().getName()[len(_VERSION_PREFIX):], st) for st in fs.listStatus(p)]
    return {int(name): (st.getLen(), now - st.getModificationTime() / 1000) for name, st in found if name.isdigit()}


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Committed version numbers under ``root``, ascending."""
    marks = _markers(spark, root)
    at = max((n for n, (size, _) in marks.items() if size), default=0)
    out = []
    while at in marks:
        if marks[at][0]:
            out.append(at)
        at -= 1
    return out[::-1]


def snapshot_next_version(spark: SparkSession, root: str) -> int:
    """The number to publish next; a number whose marker has been empty for
    ``STALE_SECONDS`` belongs to a dead writer and is stepped over."""
    marks = _markers(spark, root)
    newest = max(marks, default=0)
    if newest and not marks[newest][0] and marks[newest][1] < STALE_SECONDS:
        return newest  # being published right now: taken
    return newest + 1


def _marker(spark: SparkSession, root: str, version: int) -> tuple[str, str] | None:
    """(folder, tag) of a committed version."""
    text = get_text(spark, _tag_path(root, version))
    if not text:
        return None
    folder, _, tag = text.partition("\n")
    return folder, tag


def _version_path(spark: SparkSession, root: str, version: int) -> str:
    found = _marker(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"version {version} under {root} is not committed")
    return os.path.join(root, found[0])


def snapshot_current(spark: SparkSession, root: str) -> str | None:
    versions = snapshot_versions(spark, root)
    return _version_path(spark, root, versions[-1]) if versions else None


def snapshot_current_version(spark: SparkSession, root: str) -> int:
    versions = snapshot_versions(spark, root)
    return versions[-1] if versions else 0


def _publish(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` exclusively with ``text``."""
    fs, p, _ = _fs_and_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            raise VersionTaken(f"{path} exists") from e
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs_and_path(spark, path)
    fs.delete(p, True)


def _tag_path(root: str, version: int) -> str:
    return os.path.join(root, "_tags", f"{_VERSION_PREFIX}{version:012d}")


def snapshot_published(spark: SparkSession, root: str, tag: str, after: int = 0) -> bool:
    """Whether a committed version above ``after`` was written with ``tag``."""
    return any(_marker(spark, root, v)[1] == tag for v in snapshot_versions(spark, root) if v > after)


def snapshot_write(df: DataFrame, root: str, version: int | None = None, buckets: int | None = None,
                   key: str | None = None, tag: str | None = None, base: int | None = None) -> str:
    """Write ``df`` as a new version under ``root`` (default: the next number).

    ``base``: the version that ``df`` was built on.  Raises ``VersionTaken``, and
    removes its own data and marker, when another writer has published
    ``version``, a later one or one after ``base``.  ``buckets``/``key``:
    repartition by the key before writing, so each file holds a hash range of
    keys.  ``tag`` names the writer in the version's marker, so a replayed job
    can tell its own committed version from another's.
    """
    spark = df.sparkSession
    if version is None:
        version = snapshot_next_version(spark, root)
    folder = f"{_VERSION_PREFIX}{version:012d}-{uuid.uuid4().hex}"
    path = os.path.join(root, folder)
    if buckets and key:
        df = df.repartition(buckets, key).sortWithinPartitions(key)
    df.write.parquet(path)
    fs, p, jvm = _fs_and_path(spark, path)
    try:
        _overtaken(spark, root, version, base)
        _publish(spark, _tag_path(root, version), f"{folder}\n{tag or ''}")
        try:
            _overtaken(spark, root, version, base)
        except VersionTaken:
            fs.delete(jvm.org.apache.hadoop.fs.Path(_tag_path(root, version)), False)
            raise
    except VersionTaken:
        fs.delete(p, True)
        raise
    return path


def _overtaken(spark: SparkSession, root: str, version: int, base: int | None) -> None:
    least = version if base is None else min(version, base)
    other = [n for n, (size, _) in _markers(spark, root).items() if size and n > least and n != version]
    if other:
        raise VersionTaken(f"version {max(other)} under {root} was published before {version}")


def snapshot_update(spark: SparkSession, root: str, build: Callable[[DataFrame | None, int], DataFrame],
                    **options) -> str:
    """Publish ``build(current version's rows or None, its number)`` as the next
    version; when another writer publishes first, build again on its result, so
    no writer's change is lost."""
    for _ in range(PUBLISH_TRIES):
        base, version = snapshot_current_version(spark, root), snapshot_next_version(spark, root)
        current = snapshot_read_version(spark, root, base) if base else None
        try:
            return snapshot_write(build(current, base), root, version=version, base=base, **options)
        except VersionTaken as e:
            taken = e
            time.sleep(RETRY_SECONDS)
    raise taken


def snapshot_read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A given committed version (what a replayed job must read again)."""
    return spark.read.parquet(_version_path(spark, root, version))


_DONE = "done"


def batch_done(spark: SparkSession, root: str, writer: str, batch_id: int) -> bool:
    """Whether the batch's version was committed and has since expired."""
    return get_text(spark, os.path.join(root, "_batches", writer, f"batch={batch_id}")) == _DONE


def batch_base_version(spark: SparkSession, root: str, writer: str, batch_id: int,
                       rebase: bool = False) -> int:
    """Queue version a micro-batch of ``writer`` starts from, recorded on first
    use so that a replay of the batch reads the same version (``rebase``:
    record the current version instead)."""
    rec = os.path.join(root, "_batches", writer, f"batch={batch_id}")
    got = None if rebase else get_text(spark, rec)
    if got is not None:
        return int(got)
    base = snapshot_current_version(spark, root)
    put_text(spark, rec, str(base))
    return base


def snapshot_expire(spark: SparkSession, root: str, keep: int = 10) -> list[int]:
    """Retention: delete the versions older than the newest ``keep`` committed
    ones (with their markers and any failed attempts among them).  A batch
    whose version was committed is recorded as done before its base goes, so a
    late replay stays a no-op.  Choose ``keep`` above the number of versions a
    running reader may still be scanning.  Returns the deleted version numbers."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    versions = snapshot_versions(spark, root)
    if len(versions) <= keep:
        return []
    oldest = versions[-keep]
    fs, p, jvm = _fs_and_path(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    ledger = Path(os.path.join(root, "_batches"))
    tags = {_marker(spark, root, v)[1] for v in versions}
    if fs.exists(ledger):
        for writer in fs.listStatus(ledger):
            for rec in fs.listStatus(writer.getPath()):
                where = rec.getPath()
                base = get_text(spark, where.toString())
                if base == _DONE or int(base) >= oldest:
                    continue
                tag = f"{writer.getPath().getName()}:{where.getName().removeprefix('batch=')}"
                if tag in tags:
                    put_text(spark, where.toString(), _DONE)
                else:  # never committed: a replay starts from the current version
                    fs.delete(where, False)
    removed = set()
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        num = name[len(_VERSION_PREFIX):].split("-")[0]
        if st.isDirectory() and name.startswith(_VERSION_PREFIX) and num.isdigit() and int(num) < oldest:
            fs.delete(Path(_tag_path(root, int(num))), False)
            fs.delete(st.getPath(), True)
            removed.add(int(num))
    return sorted(removed)


def snapshot_read(spark: SparkSession, root: str, schema=None) -> DataFrame:
    cur = snapshot_current(spark, root)
    if cur is None:
        if schema is None:
            raise FileNotFoundError(f"no snapshot under {root}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(cur)


# ---------------------------------------------------------------------------
# Bucketed catalog table with a swap (co-located keyed joins)
# ---------------------------------------------------------------------------

def read_bucketed(spark: SparkSession, table: str) -> DataFrame | None:
    """Current content of a swapped table, finishing an interrupted swap first."""
    nxt = f"{table}__next"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(nxt):
        spark.sql(f"ALTER TABLE {nxt} RENAME TO {table}")
    return spark.table(table) if spark.catalog.tableExists(table) else None


def _bucket_layout(spark: SparkSession, table: str) -> tuple[str, str]:
    """(EXTERNAL or MANAGED, number of buckets) of a catalog table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return rows.get("Type", ""), rows.get("Num Buckets", "")


def swap_bucketed(df: DataFrame, table: str, key: str, buckets: int, location: str | None = None,
                  keep: int = 2) -> None:
    """Write ``df`` bucketed and sorted by ``key`` into a new directory, then
    switch the table's location to it: one catalog change, so a reader finds the
    old or the new content at any time and a crash at any step leaves one of
    them.  Joins on ``key`` against the table read it without a shuffle (its scan
    is already hash-partitioned into ``buckets``); only the other side moves.
    ``location`` (default: a folder of the warehouse) holds one directory per
    write; after the switch the newest ``keep`` stay, the current one included.
    A table with another number of buckets, or a managed one, is replaced by
    drop and rename instead; ``read_bucketed`` finishes that after a crash."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark = df.sparkSession
    nxt = f"{table}__next"
    read_bucketed(spark, table)
    location = location or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), f"{table}__data")
    spark.sql(f"DROP TABLE IF EXISTS {nxt}")  # external: its files stay
    path = os.path.join(location, f"v={uuid.uuid4().hex}")
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(nxt)
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {nxt} RENAME TO {table}")
    elif _bucket_layout(spark, table) == ("EXTERNAL", str(buckets)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        spark.sql(f"DROP TABLE {nxt}")
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {nxt} RENAME TO {table}")
    fs, root, _ = _fs_and_path(spark, location)
    current = os.path.basename(path)
    older = sorted((st for st in fs.listStatus(root)
                    if st.isDirectory() and st.getPath().getName().startswith(_VERSION_PREFIX)
                    and st.getPath().getName() != current),
                   key=lambda st: st.getModificationTime(), reverse=True)
    for st in older[keep - 1:]:
        fs.delete(st.getPath(), True)
