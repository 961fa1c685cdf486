"""Writers. Histories are merged by key, so late rows join their day and reruns change nothing."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cleaning import dedupe_first
from ..session import scratch_path


def _balanced(df: DataFrame, column: str) -> DataFrame:
    """Few files per partition value; a value with most of the rows is split at run time."""
    return df.hint("rebalance", column)


def sink_append(df: DataFrame, path: str, partition: str = "fetch_date") -> None:
    """Add rows to a history; new columns are merged when it is read."""
    _balanced(df, partition).write.mode("append").partitionBy(partition).parquet(path)


def sink_replace_days(df: DataFrame, path: str, partition: str = "fetch_date") -> None:
    """Rewrite only the partition values present in ``df``: safe to repeat."""
    (_balanced(df, partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def read_history(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A history; without its ``schema`` the files' own are merged, which reads all their footers."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def sink_merge_days(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column],
                    partition: str = "fetch_date") -> list:
    """Add rows to a history and keep the first row of each key in ``order``; returns the days that changed.

    Only the days in ``df`` are read and written; of rows equal in ``order`` the new one stays.
    ``keys`` hold the partition column or decide it. The merged days are written beside the history
    first, so a failure leaves either the old or the new state of a day, and a repeat ends the same.
    The history's columns are kept beside it (``_schema.json``), so that no merge looks at its files' footers.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "merge")
    df.write.parquet(f"{staged}/new")
    new = spark.read.schema(df.schema).parquet(f"{staged}/new")
    both = new.withColumn("_old", F.lit(False))
    schema = merged_schema(spark, path, new)
    if exists(spark, path):
        old = spark.read.schema(schema).parquet(path)
        touched = new.select(partition).distinct()
        kept = old.join(touched, old[partition].eqNullSafe(touched[partition]), "left_semi")
        both = both.unionByName(kept.withColumn("_old", F.lit(True)), allowMissingColumns=True)
    merged = dedupe_first(both, keys, [*order, F.col("_old")]).drop("_old")
    merged.write.parquet(f"{staged}/merged")
    write_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())
    sink_replace_days(spark.read.schema(merged.schema).parquet(f"{staged}/merged"), path, partition)
    days = [r[0] for r in new.select(partition).distinct().collect()]  # as many as the calendar has
    remove(spark, staged)
    return days


def refresh_days(history: DataFrame, path: str, days: Sequence, build: Callable[[DataFrame], DataFrame],
                 partition: str = "fetch_date") -> DataFrame:
    """Bring a table of daily figures up to a history of which only ``days`` have changed.

    ``build`` makes the figures, which have the ``partition`` column, of any days; only the days given are
    read from the history and written again. The first time, and when there are other columns now, all are.
    """
    spark = history.sparkSession
    schema = build(history).schema
    kept = read_text(spark, f"{path}/{SCHEMA_FILE}")
    known = kept is not None and StructType.fromJson(json.loads(kept)).names == schema.names
    some = F.col(partition).isin([d for d in days if d is not None])
    if None in days:
        some |= F.col(partition).isNull()
    rows = build(history.where(some) if known else history)
    if not known:
        remove(spark, path)
    sink_replace_days(rows, path, partition)
    write_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())
    return spark.read.schema(schema).parquet(path)


SCHEMA_FILE = "_schema.json"  # a name that readers of the table pass over


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own with all it holds."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; the same text is not written again."""
    if read_text(spark, path) == text:
        return
    fs, where = _file_system(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def merged_schema(spark: SparkSession, path: str, new: DataFrame) -> StructType:
    """The columns of ``new``, then those that only the history has."""
    own = {f.name for f in new.schema}
    kept = read_text(spark, f"{path}/{SCHEMA_FILE}")
    if kept is not None:
        old = StructType.fromJson(json.loads(kept))
    elif exists(spark, path):  # a history from before the file: its footers are read this once
        old = read_history(spark, path).schema
    else:
        old = []
    return StructType([*new.schema, *(f for f in old if f.name not in own)])


def sink_overwrite(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Replace a table; with ``skip_empty`` an empty frame leaves it as it was.

    The new table is written beside the old one, which is moved aside before the new one takes its
    place and deleted last; if the new one cannot take it, the old one is put back. A folder cannot be
    replaced in one step, so readers that must never miss the table read one that ``sink_publish`` writes.
    """
    spark = df.sparkSession
    beside, aside = f"{path.rstrip('/')}__new", f"{path.rstrip('/')}__old"
    df.write.mode("overwrite").parquet(beside)
    fs, new = _file_system(spark, beside)
    old, kept = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, aside))
    if skip_empty and spark.read.schema(df.schema).parquet(beside).isEmpty():
        fs.delete(new, True)
        return False
    if fs.exists(old):
        fs.delete(kept, True)
        if not fs.rename(old, kept):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, old):
        fs.rename(kept, old)
        raise OSError(f"cannot put {beside} in its place")
    fs.delete(kept, True)
    return True


def sink_publish(df: DataFrame, table: str, folder: str, bucket_by: Sequence[str] = (), buckets: int = 0,
                 keep: int = 2) -> None:
    """Replace a catalog table in one step: it names the old files until the new ones are complete.

    Every version is written to a folder of its own below ``folder`` and then named by the table;
    the newest ``keep`` stay, so that queries that began before the change end well, and so do
    those that a snapshot names (``snapshot_published``). With ``bucket_by`` the files are hashed into ``buckets`` by these columns and sorted by them, and statistics
    are gathered, so that joins and groupings by them need no exchange of this side.
    """
    spark = df.sparkSession
    where = f"{folder.rstrip('/')}/version={dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
    staged = f"{table}__staged"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    writer = df.write.format("parquet").option("path", where)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(staged)
    spark.sql(f"ANALYZE TABLE {staged} COMPUTE STATISTICS FOR ALL COLUMNS")
    if spark.catalog.tableExists(table) and spark.table(table).schema == spark.table(staged).schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{where}'")
        spark.sql(f"DROP TABLE {staged}")
    else:  # the first version, or other columns
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    _drop_versions(spark, folder, keep)


SNAPSHOTS_FILE = "_snapshots.json"  # version of each day that has a snapshot, beside the versions


def published_snapshots(spark: SparkSession, folder: str) -> dict[str, str]:
    """Version by day (yyyymmdd) of the snapshots of a published table."""
    return json.loads(read_text(spark, f"{folder.rstrip('/')}/{SNAPSHOTS_FILE}") or "{}")


def _drop_versions(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete the versions that are neither among the newest ``keep`` nor named by a snapshot."""
    versions, named = sorted(folders(spark, folder, "version=")), set(published_snapshots(spark, folder).values())
    remove_folders(spark, folder, lambda name: name in versions[:-keep] and name not in named)


def snapshot_published(spark: SparkSession, table: str, folder: str, run_date: dt.date, days: int = 14,
                       keep: int = 2) -> str:
    """Keep the version that ``table`` names now as the snapshot of a day; returns the snapshot's table.

    No row is read or copied: ``<table>_snap_<yyyymmdd>`` is a further table of the catalog over the same files,
    in the same buckets, and ``sink_publish`` leaves a version alone as long as a snapshot names it. A second
    snapshot of a day takes the place of the first. Snapshots older than ``days`` go, and with them the
    versions that nothing names any more; the newest ``keep`` always stay.
    """
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type
    day, oldest = f"{run_date:%Y%m%d}", f"{run_date - dt.timedelta(days=days):%Y%m%d}"
    known = published_snapshots(spark, folder) | {day: where.rstrip("/").rpartition("/")[2]}
    # the version is named first, so that nothing between here and the new table can delete it
    write_text(spark, f"{folder.rstrip('/')}/{SNAPSHOTS_FILE}", json.dumps(known))
    name = f"{table}_snap_{day}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} LIKE {table} USING parquet LOCATION '{where}'")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    for old in [d for d in known if d < oldest]:
        spark.sql(f"DROP TABLE IF EXISTS {table}_snap_{old}")
        del known[old]
    write_text(spark, f"{folder.rstrip('/')}/{SNAPSHOTS_FILE}", json.dumps(known))
    _drop_versions(spark, folder, keep)
    return name


def sink_csv(df: DataFrame, path: str) -> None:
    """Text as it is, blanks included."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def sink_raw_json(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Raw zone copy under its day."""
    df.write.mode("overwrite").json(f"{path}/dt={run_date:%Y-%m-%d}")


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders directly below ``path`` that begin with ``prefix``."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    return [e.getPath().getName() for e in fs.listStatus(root) if e.getPath().getName().startswith(prefix)]


def newest_partition(spark: SparkSession, path: str, column: str = "fetch_date") -> str | None:
    """The greatest value of a history's partition column, from the names of its folders alone.

    Days are written so that their text sorts like the days; null is not among them.
    """
    names = folders(spark, path, f"{column}=")
    values = [unquote(n.partition("=")[2]) for n in names]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)


def read_newest(spark: SparkSession, path: str, schema: StructType | str, column: str = "fetch_date") -> DataFrame:
    """The newest day of a history: one folder is listed by name and read, whatever the history holds.

    ``latest_snapshot`` is the form for tables that are not partitioned by the day.
    """
    rows = spark.read.schema(schema).parquet(path)
    newest = newest_partition(spark, path, column)
    return rows.where(F.lit(False)) if newest is None else rows.where(F.col(column) == F.lit(newest).cast(rows.schema[column].dataType))


def remove_folders(spark: SparkSession, path: str, unwanted: Callable[[str], bool]) -> None:
    """Delete the folders directly below ``path`` whose name is unwanted."""
    fs, root = _file_system(spark, path)
    for entry in fs.listStatus(root):
        if unwanted(entry.getPath().getName()):
            fs.delete(entry.getPath(), True)


def table_snapshot(df: DataFrame, path: str, run_date: dt.date, days: int = 14) -> None:
    """Dated copy; copies older than ``days`` are removed. Published tables need none (``snapshot_published``)."""
    df.write.mode("overwrite").parquet(f"{path}/snap_date={run_date:%Y%m%d}")
    oldest = f"snap_date={run_date - dt.timedelta(days=days):%Y%m%d}"
    remove_folders(df.sparkSession, path,
                   lambda name: name.startswith("snap_date=") and name < oldest)
