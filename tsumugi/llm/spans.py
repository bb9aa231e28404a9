"""Problem 9: long verbatim spans shared between records.

Each window of ``span`` characters is stood for by the least hash of the shorter grams in it (its anchor); equal windows have
equal anchors. Partition sketches of the anchors, merged, overestimate in how many records a window's anchor occurs. A second
pass hashes only the windows whose anchor is estimated repeated to 96 bits and groups those exactly; no shared window is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsumugi.llm import sketch
from tsumugi.llm.codes import Rolling, code_points, inside, owners, sliding_min
from tsumugi.llm.common import chunked, only, texts_of

#: Rows of a vectorised step.
ROWS = 500
SECOND_BASE = 0xD6E8FEB86659FD93


def anchors(texts: list[str], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one text, their anchors, the text's index of each, and all code points."""
    points, offsets = code_points(texts)
    gram = max(1, span // 2)
    least = sliding_min(Rolling(points).windows(gram), span - gram + 1)
    starts = np.flatnonzero(inside(offsets, span, len(points)))
    return starts, least[starts], owners(offsets)[starts], points


def shared_windows(df: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """``doc, at``: the start of each window of ``span`` characters that also occurs in another record."""
    source = only(df.where(F.length(df[text_col]) >= span), doc=F.col(id_col).cast("long"), text=text_col)
    expected = source.agg(F.sum(F.length("text") / (span // 4 + 1))).first()[0] or 0

    def once_a_record(batch: pa.RecordBatch) -> np.ndarray:
        keys = []
        for part in chunked([batch], ROWS):
            _, least, owner, _ = anchors(texts_of(part.column(1)), span)
            change = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])) if len(least) else []
            key, who = least[change], owner[change]
            order = np.lexsort((key, who))
            key, who = key[order], who[order]
            keys.append(key[np.concatenate([[True], (key[1:] != key[:-1]) | (who[1:] != who[:-1])])] if len(key) else key)
        return np.concatenate(keys) if keys else np.empty(0, np.uint64)

    # a record that comes in twice under one id raises the estimate only, which loses nothing
    bits = sketch.build(source, once_a_record, sketch.width_for(int(expected)))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, ROWS):
            starts, least, owner, points = anchors(texts_of(batch.column(1)), span)
            change = np.concatenate([[True], least[1:] != least[:-1]]) if len(least) else np.empty(0, bool)
            flag = sketch.repeated(bits.value, least[change])[np.cumsum(change) - 1] if len(least) else change
            at, who = starts[flag], owner[flag]
            if not len(at):
                continue
            first = np.searchsorted(owner, np.arange(batch.num_rows))
            begin = np.where(first < len(starts), starts[np.minimum(first, len(starts) - 1)], 0)
            one, two = Rolling(points).windows(span)[at], Rolling(points, SECOND_BASE).windows(span)[at]
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(docs[who].astype(np.int64)), pa.array((at - begin[who]).astype(np.int32))], names=["h1", "h2", "doc", "at"])

    found = source.mapInArrow(windows, "h1 long, h2 int, doc long, at int")
    groups = found.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("h1", "h2")
    return found.join(groups, ["h1", "h2"], "left_semi").select("doc", "at")


def shared_spans(df: DataFrame, id_col: str, text_col: str, span: int = 200) -> DataFrame:
    """How much of each record's text lies in verbatim spans of at least ``span`` characters that occur in another record.

    Columns: ``id_col``, ``n_chars``, ``n_spans``, ``shared_chars``, ``shared_share``; a row for each distinct id with a text.
    Null texts give no row; empty and short ones have 0. Repeats of a row under the same id aren't shared with each other; a
    span repeated only within its record doesn't count. Ids are integers. Other columns are ignored; empty tables give no rows.
    """
    starts = shared_windows(df, id_col, text_col, span).groupBy("doc").agg(F.array_sort(F.collect_set("at")).alias("starts"))  # bounded by one text
    gaps = F.transform(F.sequence(F.lit(1), F.size("starts") - 1), lambda i: F.get("starts", i) - F.get("starts", i - 1))
    gaps = F.when(F.size("starts") > 1, gaps).otherwise(F.array().cast("array<int>"))
    covered = F.aggregate(gaps, F.lit(span), lambda a, g: a + F.least(g, F.lit(span)))
    spans = starts.select("doc", covered.alias("shared_chars"), (F.size(F.filter(gaps, lambda g: g > 1)) + 1).alias("n_spans"))
    sizes = only(df.where(df[text_col].isNotNull()), doc=F.col(id_col).cast("long"), n_chars=F.length(df[text_col]).cast("long")).groupBy("doc").agg(F.max("n_chars").alias("n_chars"))
    n, shared = F.col("n_chars"), F.coalesce("shared_chars", F.lit(0)).cast("long")
    return sizes.join(spans, "doc", "left").select(F.col("doc").alias(id_col), n, F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), shared.alias("shared_chars"), F.when(n > 0, shared / n).otherwise(F.lit(0.0)).alias("shared_share"))
