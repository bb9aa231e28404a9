"""Problem 6: groups of records that are nearly the same, by a size-aware heavy-light join.

Copies form a class first; classes are joined. Each class enumerates fixed-size subsets of its minwise sample; a sketch leaves
out subsets that only one class has. Of the inverted lists of the rest, short ones are joined as they are, long ones are scanned in
blocks, each pair of blocks a task of its own. The boundary is where a list costs more than a task's share of all pairs.
Pairs whose prints and sizes allow it are verified by their exact sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsumugi.llm import sketch
from tsumugi.llm.common import stage, unstage
from tsumugi.llm.shingles import CHOSEN, ELEMENTS, OTHERS, PRINTS, plausible, prints, sample_array, signed, subset_keys, verified

#: Lists up to this are never split.
LEAST_BOUNDARY = 1000


def postings(classes: DataFrame) -> DataFrame:
    """``k, id, size`` and ``PRINTS``: the subsets of each class that another class may have, with its print and size."""

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        return subset_keys(sample_array(batch.column(2))).view(np.uint64).ravel()

    bits = sketch.build(classes.select("id", "size", "sample"), keys_of, sketch.width_for(ELEMENTS // CHOSEN * classes.count() // 2))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sample = sample_array(batch.column(2))
            keys = subset_keys(sample)
            row, col = np.nonzero(sketch.repeated(bits.value, keys.view(np.uint64).ravel()).reshape(keys.shape))
            yield pa.RecordBatch.from_arrays([pa.array(keys[row, col]), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), *(pa.array(p[row]) for p in prints(sample).T)], names=["k", "id", "size", *PRINTS])

    return classes.select("id", "size", "sample").mapInArrow(run, "k long, id long, size int" + "".join(f", {p} long" for p in PRINTS))


def class_pairs(classes: DataFrame) -> DataFrame:
    """``a, b`` (a < b): pairs of classes that share a subset and may be similar."""
    spark = classes.sparkSession
    posted = stage(postings(classes), "postings")
    lists = posted.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    work = lists.agg(F.sum(F.col("n") * F.col("n") / 2)).first()[0] or 0.0
    boundary = int(max(LEAST_BOUNDARY, (2 * work / max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))) ** 0.5))
    lists = stage(lists, "lists")  # both are deleted below

    other_side = [F.col("id").alias("b"), F.col("size").alias("sb"), *(F.col(p).alias(q) for p, q in zip(PRINTS, OTHERS))]

    def meet(rows: DataFrame, on: list[str]) -> DataFrame:
        other = rows.select(*on, *other_side)
        return rows.join(other, on).where((F.col("id") < F.col("b")) & plausible(F.col("size"), F.col("sb"))).select(F.col("id").alias("a"), "b")

    light = meet(posted.join(lists.where(F.col("n") <= boundary).select("k"), "k", "left_semi"), ["k"])
    blocks = F.ceil(F.col("n") / boundary).cast("int")
    placed = posted.join(lists.where(F.col("n") > boundary), "k").withColumn("blocks", blocks).withColumn("own", F.pmod(F.hash("id"), F.col("blocks")))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    left, right = tiles.where("own = x"), tiles.where("own = y").select("k", "x", "y", *other_side)
    heavy = left.join(right, ["k", "x", "y"]).where((F.col("id") != F.col("b")) & plausible(F.col("size"), F.col("sb"))).select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b"))
    pairs = stage(light.unionByName(heavy).distinct(), "pairs")
    unstage(posted, lists)
    return pairs


def near_duplicates(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (``id, rep``) and similar pairs of classes (``a, b, similarity``; a < b) of bodies (``id, text``).

    ``rep`` is the least id of the records with the same text but for white space. Null, empty and short bodies are in neither;
    repeated rows of an id count once; ids are integers; an empty table gives empty results. No link between different texts is
    left out but with the small probability given in ``shingles``; there is no cap on lists, partners or candidates.
    """
    records = stage(signed(bodies).withColumn("sample", F.col("sample")), "records")
    members = records.select("id", "h1", "h2").distinct()
    least = members.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = stage(members.join(least, ["h1", "h2"]).select("id", "rep"), "members")
    copies = members.where("id <> rep").select("id")
    classes = records.join(copies, "id", "left_anti").dropDuplicates(["id"])
    classes = stage(classes, "classes")
    unstage(records)
    pairs = class_pairs(classes)
    unstage(classes)
    similar = stage(verified(pairs, bodies), "similar")
    unstage(pairs)
    return members, similar


def expanded(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b`` (a <> b) of all records, from the classes: copies of each other, and members of similar classes."""
    other = members.select("rep", F.col("id").alias("b"))
    within = members.join(other, "rep").where("id < b").select(F.col("id").alias("a"), "b")
    across = pairs.select(F.col("a").alias("rep"), F.col("b").alias("rep_b")).join(members.withColumnRenamed("id", "a"), "rep").select("a", F.col("rep_b").alias("rep")).join(other, "rep").select("a", "b")
    return within.unionByName(across)


def components(members: DataFrame, pairs: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``id, rep, group_id``: records linked through similar classes have the least id among them as their group.

    Each round every class takes the least label around it, and then its label's label; rounds go on until no label changes,
    their number is logarithmic in a group's longest chain. Labels stay distributed and are written each round.
    """
    links = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(members.where("id = rep").select("id", F.col("id").alias("label")), "labels")
    for _ in range(most_rounds):
        around = links.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around.withColumnRenamed("a", "id"), "id", "left").select("id", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("low2"))
        after = stage(lower.join(jump, "low").select("id", "label", F.least("low", "low2").alias("new")), "labels")
        if after.where("new < label").isEmpty():
            break
        labels = after.select("id", F.col("new").alias("label"))
    else:
        raise RuntimeError(f"groups still change after {most_rounds} rounds")
    return members.join(labels.select(F.col("id").alias("rep"), F.col("label").alias("group_id")), "rep").select("id", "rep", "group_id")
