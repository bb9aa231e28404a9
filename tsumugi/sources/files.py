"""Files in and out: corpora, definitions, results, checkpoints of rounds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsumugi import schemas


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def staged(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder (``spark.checkpoint.dir``; where that is unset, one of this machine), a folder for each ``by``; and its URI."""
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="tsumugi-")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{where.rstrip('/')}/tsumugi/{uuid.uuid4().hex}/{name}")
    path = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def opened(folder: str) -> Iterator[pa.NativeFile]:
    """The parquet files of a folder, by its URI, one after the other; readable in a task."""
    system, place = pyarrow.fs.FileSystem.from_uri(folder)
    for info in sorted(system.get_file_info(pyarrow.fs.FileSelector(place, allow_not_found=True)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                yield file


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A parquet, JSON or CSV file or folder, by its ending; parquet if it has none. CSV may have line ends in quotes."""
    require(spark, path)
    reader, kind = spark.read if schema is None else spark.read.schema(schema), path.rstrip("/").rpartition(".")[2].lower()
    if kind in ("json", "jsonl"):
        return reader.json(path)
    if kind == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return reader.parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A corpus with ``row_id, title, body, category`` and any other columns; in a CSV without ``row_id``, the row's number.

    Numbers follow the order of files and rows, and so don't depend on partitions. Strings such as ``NA`` stay.
    """
    df = read(spark, path)
    if "row_id" not in df.columns:
        df = numbered(df)
    return df.select(F.col("row_id").cast("long").alias("row_id"), *[F.col(c).cast("string").alias(c) for c in ("title", "body", "category")], *[c for c in df.columns if c not in ("row_id", "title", "body", "category")])


def numbered(df: DataFrame) -> DataFrame:
    """``df`` of a file or folder with ``row_id``, the row's number from 0 in the order of files, their splits, and rows.

    Rows are numbered within their splits, as they are read; the numbers of rows before each split, one row a split, are added.
    """
    name, place = F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id()
    split = F.shiftrightunsigned("_place", 33)
    rows = df.select("*", name, F.col("_metadata.file_block_start").alias("_start"), place.alias("_place"))
    # a task reads files one after the other, so that the least place of a split is where it begins
    splits = rows.groupBy("_file", "_start", split.alias("_task")).agg(F.count("*").alias("_rows"), F.min("_place").alias("_least"))
    before = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(Window.orderBy("_file", "_start", "_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    full = rows.withColumn("_task", split).join(before, ["_file", "_start", "_task"])
    return full.select(*[F.col(c) for c in df.columns], (F.col("_before") + F.col("_place") - F.col("_least")).alias("row_id"))


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """``category, definition``; an absent file is an empty table."""
    return read(spark, path).select("category", "definition") if exists(spark, path) else spark.createDataFrame([], schemas.DEFINITION)


def flat(df: DataFrame) -> DataFrame:
    """``df`` with arrays, maps and structs as JSON, for CSV."""
    deep = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, deep) else F.col(f.name) for f in df.schema.fields])


def write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet, JSON or CSV by the path's ending; folders are made as needed."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "csv":
        flat(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    elif kind in ("json", "jsonl"):
        df.write.mode(mode).json(path)
    else:
        df.write.mode(mode).parquet(path)


def append_round(df: DataFrame, path: str, round_: int) -> None:
    """A round's rows in a partition of its own, replaced as a whole if the round is repeated."""
    df.drop("round").write.mode("overwrite").parquet(f"{path.rstrip('/')}/round={round_}")


def pending(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that have no answer yet, for resuming."""
    return requests.join(answers.select("category", "style", "round", "batch_idx").distinct(), ["category", "style", "round", "batch_idx"], "left_anti")
