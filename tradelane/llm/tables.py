"""Reading tables and cutting lineage in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradelane.session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_RECORDED: list[tuple[str, str]] = []  # application and path of the scratch tables of the stage at work
_recording = False


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: lost executors cost no rework."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _recording:
        _RECORDED.append((spark.sparkContext.applicationId, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[None]:
    """What ``cut`` writes inside is scratch, for ``drop_recorded`` to remove."""
    global _recording
    before, _recording = _recording, True
    try:
        yield
    finally:
        _recording = before


def drop_recorded(spark: SparkSession) -> None:
    """Remove recorded scratch tables, once what was made of them is written."""
    own = spark.sparkContext.applicationId
    for app, path in [x for x in _RECORDED if x[0] == own]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _RECORDED.remove((app, path))


def column(name: str, of: str | None = None) -> Column:
    """A column, or a field of the struct ``of``, whatever characters its name has."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(quoted if of is None else f"{of}.{quoted}")


def whole(docs: DataFrame, name: str = "kept") -> Column:
    """All columns of ``docs`` as one struct, so that no name among them can clash."""
    return F.struct(*(column(c).alias(c) for c in docs.columns)).alias(name)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """Only the columns an operator needs, null text as empty; other columns cannot clash."""
    return docs.select(column(id_col).cast("long").alias("doc_id"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"), *keep)


def numbered(docs: DataFrame) -> DataFrame:
    """row, a number of each row of ``docs``, and kept, the row, written once: scans agree however they are split."""
    return cut(docs.select(whole(docs)).withColumn("row", F.monotonically_increasing_id()), "numbered")


def of_numbered(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id and text of ``numbered`` rows, null text as empty."""
    return rows.select("row", column(id_col, "kept").cast("long").alias("doc_id"),
                       F.coalesce(column(text_col, "kept"), F.lit("")).alias("text"))


def placed(docs: DataFrame) -> DataFrame:
    """place, the number of each row of the stored ``docs`` by file name, then place in the file, and kept, the row.

    It does not depend on how the scan is split. Only the counts of the files are ordered.
    """
    file = F.col("_metadata.file_path").alias("file")
    sizes = cut(docs.groupBy(file).agg(F.count(F.lit(1)).alias("n")), "file-sizes")
    # part numbers have more digits beyond 100,000 files
    before = F.sum("n").over(W.orderBy(F.length("file"), "file").rowsBetween(W.unboundedPreceding, W.currentRow))
    begin = sizes.select("file", (before - F.col("n")).alias("begin"))
    rows = docs.select(whole(docs), file, F.col("_metadata.row_index").alias("at")).join(begin, "file")
    return rows.select("kept", (F.col("begin") + F.col("at")).alias("place"))


def labelled_sample(spark: SparkSession, sf_dir: str, label: str, limit: int,
                    only=None) -> DataFrame:
    """At most ``limit`` labelled ids with their label, chosen by a hash of the id.

    A doc_id labelled twice counts once, with its largest label; null ids and labels are left out.
    """
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    labels = labels.where("doc_id is not null and label is not null")
    if only is not None:
        labels = labels.where(only)
    return (labels.groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def fold() -> F.Column:
    """0 to 4 by the id; 0 is held out from learning."""
    return F.crc32(F.col("doc_id").cast("string")) % 5
