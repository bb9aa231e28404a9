"""Plumbing shared by the corpus operators: shared folder, staged tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` sees it, for Java regular expressions.
WHITE = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"

#: Narrow rows (under a hundred bytes) that are broadcast at most: 20 MB.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; only where that is unset (tests), a folder of this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="tsumugi-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tsumugi/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to one in ``under``, and read it back, which cuts its lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{under}/{uuid.uuid4().hex}/{name}" if under else new_folder(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables from which everything has been written on; none of it can be needed again, whatever executor is lost."""
    for df in tables:
        remove(df.sparkSession, df._staged_at)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows, to be broadcast if these are few enough; else it is joined as any other."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def trimmed(col: Column) -> Column:
    """``col`` without white space of any kind around it."""
    return F.regexp_replace(col, f"^{WHITE}+|{WHITE}+$", "")


def texts_of(column: pa.Array) -> list[str]:
    """Values of a string column, null as an empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def chunked(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut batches to ``rows`` rows, which bounds the memory of a vectorised step."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def only(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Just the named columns, so that other columns and clashing names of the input can't interfere."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
