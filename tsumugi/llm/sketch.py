"""Count-min sketch saturated at two, built in partitions, merged chunk by chunk, read by all tasks.

Each of ``depth`` rows has two bits a cell: seen, and seen again. Counts are overestimates, so "at most once" is certain and no
repeated key is ever lost. ``width`` follows the number of keys up to ``MAX_WIDTH``; beyond that more unrepeated keys pass,
results stay the same. What is sent to the driver and broadcast is ``depth * width / 8`` bytes, 32 MB at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tsumugi.llm.codes import mix

MAX_WIDTH, MIN_WIDTH, DEPTH = 1 << 27, 1 << 16, 2
#: Cells in a chunk of the merge.
CHUNK = 1 << 16
#: Keys a task holds before it emits the chunks they touch, which bounds its memory whatever the width.
HELD = 1 << 22


def width_for(keys: int) -> int:
    """Eight cells a key, a power of two between the bounds."""
    return int(min(MAX_WIDTH, max(MIN_WIDTH, 1 << int(np.ceil(np.log2(max(1, keys) * 8))))))


def cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mix(keys, row + 1) & np.uint64(width - 1)).astype(np.int64)


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], width: int) -> Broadcast:
    """Sketch of the keys of all batches; ``keys_of`` returns each key once for each record that counts. Broadcast: bits by row."""
    spark = df.sparkSession

    def chunks(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The chunks that ``keys`` touch."""
        for row in range(DEPTH):
            at, n = np.unique(cells(keys, row, width), return_counts=True)
            cuts = np.flatnonzero(np.concatenate([[True], at[1:] // CHUNK != at[:-1] // CHUNK, [True]])) if len(at) else []
            for a, b in zip(cuts, cuts[1:]):
                once, again, begin = np.zeros(CHUNK, bool), np.zeros(CHUNK, bool), int(at[a]) // CHUNK * CHUNK
                once[at[a:b] - begin] = True
                again[at[a:b][n[a:b] > 1] - begin] = True
                yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([begin], pa.int64()), *(pa.array([zlib.compress(np.packbits(x).tobytes(), 1)], pa.binary()) for x in (once, again))], names=["sketch_row", "at", "once", "again"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(keys_of(batch))
            n += len(held[-1])
            if n >= HELD:
                yield from chunks(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from chunks(np.concatenate(held))

    def merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = again = np.zeros(CHUNK // 8, np.uint8)
        for part in parts:
            for x, y in zip(part.column("once").to_pylist(), part.column("again").to_pylist()):
                x, y = (np.frombuffer(zlib.decompress(z), np.uint8) for z in (x, y))
                again = again | y | (once & x)
                once = once | x
        if again.any():
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([zlib.compress(again.tobytes(), 1)], pa.binary())], names=["sketch_row", "at", "again"])

    merged = df.mapInArrow(count, "sketch_row int, at long, once binary, again binary").groupBy("sketch_row", "at").applyInArrow(merge, "sketch_row int, at long, again binary")
    bits = np.zeros((DEPTH, width // 8), np.uint8)
    for row, at, again in merged.toLocalIterator():
        bits[row, at // 8 : at // 8 + CHUNK // 8] = np.frombuffer(zlib.decompress(bytes(again)), np.uint8)
    return spark.sparkContext.broadcast(bits)


def repeated(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may have been counted twice or more; never false for one that was."""
    width, out = bits.shape[1] * 8, np.ones(len(keys), bool)
    for row in range(len(bits)):
        at = cells(keys, row, width)
        out &= (bits[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


__all__ = ["build", "repeated", "width_for"]
