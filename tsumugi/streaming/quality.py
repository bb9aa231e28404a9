"""Quality rules on arriving candidates: the batch expressions on a stream, with repeats dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tsumugi.config import Config
from tsumugi.operators.quality import language_problem, length_problem, safety_problem, with_ranges


def checked(stream: DataFrame, styles: DataFrame, config: Config = Config()) -> DataFrame:
    """``stream`` (``style, title, body``) with ``reasons`` of the rules that need no references; works on batches alike."""
    full = with_ranges(stream, styles, config)
    title, body = F.col("title"), F.col("body")
    malformed = title.isNull() | body.isNull()
    tests = {"malformed": malformed, "length": length_problem(title, body, F.col("title_min"), F.col("title_max"), F.col("body_min"), F.col("body_max"), config.body_range).isNotNull(), "language": language_problem(body, config).isNotNull(), "title_safety": safety_problem(title).isNotNull(), "body_safety": safety_problem(body).isNotNull()}
    found = F.array(*[F.when(t & (F.lit(True) if r == "malformed" else ~malformed), r) for r, t in tests.items()])
    return full.withColumn("reasons", F.filter(found, lambda r: r.isNotNull())).drop("title_min", "title_max", "body_min", "body_max")


def first_of_each(stream: DataFrame, id_col: str, time_col: str, late: str = "1 hour") -> DataFrame:
    """Each id once; state is dropped ``late`` after it came."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark([id_col])


def pass_counts(stream: DataFrame, time_col: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Accepted and rejected candidates by tumbling window; late rows within ``late`` still count."""
    ok = F.size("reasons") == 0
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, window).alias("w")).agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("rejected")).select(F.col("w.start").alias("start"), "passed", "rejected")


def sink(stream: DataFrame, path: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Append to parquet, exactly once by the checkpoint; processes what is there, then ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).options(**options).outputMode("append").trigger(availableNow=True).start()
