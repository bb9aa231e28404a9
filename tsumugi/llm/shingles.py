"""Sets of character 5-grams, their minwise samples, and exact similarity.

Problems 2 and 6 fix the sets: distinct sequences of five characters, white space left out, of bodies of 120 characters or
more, similar from a Jaccard of 0.70 on. A minwise sample stands for each set, and its disjoint subsets of a few neighbouring
elements are enumerated, 48 of four. As no element is in two subsets, sets of Jaccard s share none with probability
(1 - s**4)**48, 1.9e-6 at 0.70. Prints, one bit for each element, leave out pairs that share a subset by chance; so many bits may
differ that a pair at 0.70 is left out with a probability of ``PRINT_MISS`` at most. Both rates fall quickly above 0.70.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsumugi.llm import sketch
from tsumugi.llm.codes import code_points, gram_hashes, inside, mix
from tsumugi.llm.common import chunked, texts_of

GRAM, LEAST_CHARS, THRESHOLD = 5, 120, 0.70
#: Elements of a sample, and of each subset.
ELEMENTS, CHOSEN = 192, 4
PRINT_MISS = 1e-6
#: The words of a print, of one set and of another.
PRINTS, OTHERS = ([f"{p}{k}" for k in range(ELEMENTS // 64)] for p in ("p", "q"))
#: Rows of a vectorised step: the grams of so many bodies fit the processor's cache.
ROWS = 200


@lru_cache(4)
def multipliers(elements: int, seed: int = 5) -> np.ndarray:
    """The odd multipliers of the sample's hash functions."""
    return np.random.default_rng(seed).integers(0, 2**31, elements, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


@lru_cache(4)
def print_bits(bits: int) -> int:
    """Bits of a print that may differ: of elements that differ with 1 - ``THRESHOLD``, half the bits do."""
    p, beyond, k = (1 - THRESHOLD) / 2, 0.0, bits
    while (beyond := beyond + comb(bits, k) * p**k * (1 - p) ** (bits - k)) <= PRINT_MISS:
        k -= 1
    return k


def compact(text: str) -> str:
    """``text`` without white space."""
    return "".join(text.split())


def samples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minwise sample (rows by ``ELEMENTS``), set size and two hashes of each compacted text.

    Texts shorter than a gram have a sample of zeros and size 0.
    """
    points, offsets = code_points(texts)
    grams = gram_hashes(points, GRAM)
    ok = inside(offsets, GRAM, len(points))
    sizes = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    values = (grams[ok] >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]]).astype(np.int64) if len(full) else np.empty(0, np.int64)
    out = np.zeros((len(texts), ELEMENTS), np.uint32)
    if len(full):
        room = np.empty_like(values)
        for k, a in enumerate(multipliers(ELEMENTS)):
            np.multiply(values, a, out=room)
            out[full, k] = np.minimum.reduceat(room, starts)
        keys = np.sort(np.repeat(full.astype(np.uint64), sizes[full]) << np.uint64(32) | values)
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        sizes = np.bincount((keys[first] >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    return out, sizes, text_hashes(texts)


def text_hashes(texts: list[str]) -> np.ndarray:
    import xxhash

    return np.array([divmod(xxhash.xxh3_128_intdigest(t.encode("utf-8", "surrogatepass")), 2**64) for t in texts], np.uint64).reshape(-1, 2)


def prints(sample: np.ndarray) -> np.ndarray:
    """One bit of each element; rows by ``PRINTS``."""
    return np.packbits(((sample * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8), axis=1).view(np.int64)


def subset_keys(sample: np.ndarray, salt: np.ndarray | None = None) -> np.ndarray:
    """Rows by subsets: a hash of the elements of each, and of ``salt`` where rows must agree in it."""
    keys = np.empty((len(sample), ELEMENTS // CHOSEN), np.uint64)
    for k in range(keys.shape[1]):
        h = np.full(len(sample), k, np.uint64) if salt is None else salt + np.uint64(k)
        for element in range(k * CHOSEN, (k + 1) * CHOSEN):
            h = mix(h ^ sample[:, element].astype(np.uint64), 3)
        keys[:, k] = h
    return keys.view(np.int64)


def grams_of(text: str) -> frozenset[str]:
    text = compact(text)
    return frozenset(text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


def jaccard(a: frozenset, b: frozenset) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 0.0


def plausible(size_a: Column, size_b: Column) -> Column:
    """Whether the prints (``PRINTS``, ``OTHERS``) and sizes allow a similarity of the threshold (sizes are of hashed grams, hence a little slack)."""
    small, large = F.least(size_a, size_b), F.greatest(size_a, size_b)
    apart = reduce(add, (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(PRINTS, OTHERS)))
    return (apart <= print_bits(ELEMENTS)) & (small >= large * (THRESHOLD - 0.02))


def likely(size_a: np.ndarray, prints_a: np.ndarray, size_b: np.ndarray, prints_b: np.ndarray) -> np.ndarray:
    """``plausible`` of arrays: sizes, and unsigned prints by rows."""
    apart = np.bitwise_count(prints_a ^ prints_b).sum(axis=1, dtype=np.int64)
    return (apart <= print_bits(ELEMENTS)) & (np.minimum(size_a, size_b) >= np.maximum(size_a, size_b) * (THRESHOLD - 0.02))


def verified(pairs: DataFrame, bodies: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, similarity`` of the pairs (``a, b``) whose bodies (``id, text``) are similar, by their exact sets.

    Only bodies of ids that occur in a pair are shuffled: a sketch of these ids, of bounded size, goes to the scan.
    """
    expected = pairs.count()
    # each id is counted twice, as the sketch tells what was counted again
    bits = sketch.build(pairs, lambda batch: np.repeat(np.unique(np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()])).view(np.uint64), 2), sketch.width_for(2 * expected))

    def needed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = sketch.repeated(bits.value, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if keep.any():
                yield batch.filter(pa.array(keep))

    texts = bodies.select("id", "text").mapInArrow(needed, "id long, text string").dropDuplicates(["id"])

    first = pairs.select("a", "b").join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a")
    return compared(first.join(texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b"), threshold)


def compared(both: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, similarity`` of the rows (``a, b, ta, tb``) whose texts are similar, by their exact sets."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(4096)(grams_of)
        for batch in batches:
            similar = np.fromiter((jaccard(known(x), known(y)) for x, y in zip(texts_of(batch.column(2)), texts_of(batch.column(3)))), float, batch.num_rows)
            keep = similar >= threshold
            yield pa.RecordBatch.from_arrays([*(batch.column(k).filter(pa.array(keep)) for k in (0, 1)), pa.array(similar[keep])], names=["a", "b", "similarity"])

    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long, similarity double")


def signed(bodies: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``id, h1, h2, size, sample`` of bodies (``id, text``) with enough characters and a gram; ``sample`` has two bytes an element.

    ``extra``: columns kept besides.
    """
    source = bodies.where(F.length("text") >= LEAST_CHARS).select("id", "text", *extra)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, ROWS):
            sample, sizes, hashes = samples([compact(t) for t in texts_of(batch.column(1))])
            h = hashes.view(np.int64)
            short = (sample >> np.uint32(16)).astype(np.uint16)
            columns = [batch.column(0), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(sizes.astype(np.int32)), pa.array([r.tobytes() for r in short], pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h1", "h2", "size", "sample", *extra]).filter(pa.array(sizes > 0))

    return source.mapInArrow(run, "id long, h1 long, h2 long, size int, sample binary" + "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in extra))


def sample_array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, ELEMENTS).astype(np.uint32)
