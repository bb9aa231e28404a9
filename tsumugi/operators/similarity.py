"""Similarity of candidates to the references of their category: n-gram containment and TF-IDF cosine, both exact.

Every candidate is held against every reference of its category. The references are written once, in blocks; a task has a block of
candidates and reads the blocks of its category one after the other, so that no row is copied, and only maxima leave a task. Within a
block the grams that many references have are a dense matrix, in which grams with the same references are one line; for the others
the lists of their references are added. Nothing is refitted per candidate. ``candidates`` and ``references`` are
``id, category, text``; null texts are empty, null categories match nothing. Results have a row for each candidate id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsumugi.functions.codes import term_counts
from tsumugi.sources.files import opened, staged

#: Characters of a block of either side, about: 8,000 and 4,000 texts of 300.
CANDIDATES, REFERENCES = 2_400_000, 1_200_000
#: Texts of a vectorised step; cells of its largest array, about; folders of a staged table.
ROWS, CELLS, FOLDERS = 128, 500_000, 256
#: Rows up to which a table of categories is broadcast.
NARROW = 200_000
#: Grams that a larger share of a block's references have are in its dense matrix.
DENSE = 0.05
_SPACE = re.compile(r"\s\s+")


def squeeze(text: str) -> str:
    return text.replace(" ", "").replace("\n", "")


def fold(text: str) -> str:
    return _SPACE.sub(" ", text).lower()


def placed(texts: DataFrame, size: int, among: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """``id, category, text, b, i``: the folder and the block, of about ``size`` characters, of each row; rows of an id are in one.

    Only categories of ``among``. Texts are shuffled once, by their block; repeated rows count once. The plan of ``texts`` runs twice.
    """
    rows = texts.where("category is not null").select(F.col("id").cast("string").alias("id"), "category", F.coalesce("text", F.lit("")).alias("text"))
    blocks = rows.select("category", F.xxhash64("id"), F.length("text").alias("n")).distinct().groupBy("category").agg(F.ceil(F.sum(F.col("n") + 1) / size).alias("n"))
    blocks, _ = staged(blocks if among is None else blocks.join(among, "category", "left_semi"), "blocks")
    # without a hint, the texts may be shuffled by category for this join before its other side is known to be small
    blocks = F.broadcast(blocks) if blocks.count() <= NARROW else blocks
    spread = rows.join(blocks, "category").withColumn("i", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).drop("n")
    full = spread.withColumn("b", F.pmod(F.xxhash64("category"), F.lit(FOLDERS)).cast("int"))
    return full.repartition(*([tasks] if tasks else []), "category", "b", "i").distinct()


def once(block: pa.Table) -> tuple[list[str], list[str]]:
    """Ids and texts of a block; repeats of an id count once."""
    kept = dict(sorted(zip(block["id"].to_pylist(), block["text"].to_pylist()), reverse=True))
    return list(kept), list(kept.values())


def counted(texts: list[str], sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [x for at in range(0, len(texts), ROWS) for x in term_counts(texts[at : at + ROWS], sizes)]


class Block:
    """A block of references: its grams, for each the references that have it, as a dense matrix or as a list."""

    def __init__(self, texts: list[str], sizes: tuple[int, ...]):
        terms = counted(texts, sizes)
        self.n = len(texts)
        self.grams, place, self.df = np.unique(np.concatenate([g for g, _ in terms]), return_inverse=True, return_counts=True)
        self.lengths = np.array([len(g) for g, _ in terms])
        self.ends = np.concatenate([[0], np.cumsum(self.lengths)])
        self.tf = np.concatenate([n for _, n in terms]).astype(np.float32)
        self.owner = np.repeat(np.arange(self.n, dtype=np.int32), self.lengths)
        self.place = place.astype(np.int32)
        del terms, place
        frequent = self.df > DENSE * self.n
        inside = frequent[self.place]
        # grams with the same counts in the same references are one line: equal sums of random numbers of 64 bits
        marks = np.random.default_rng(1).integers(0, 2**64, self.n, np.uint64, endpoint=False)
        sums = np.zeros(len(self.grams), np.uint64)
        np.add.at(sums, self.place[inside], marks[self.owner[inside]] * self.tf[inside].astype(np.uint64))
        dense = np.flatnonzero(frequent)
        _, first, line = np.unique(sums[dense], return_index=True, return_inverse=True)
        self.line = np.full(len(self.grams), -1, np.int32)
        self.line[dense] = line
        self.lines = len(first)
        chosen = np.zeros(len(self.grams), bool)
        chosen[dense[first]] = True
        chosen = chosen[self.place]
        self.matrix = np.zeros((self.lines, self.n), np.float32)
        self.matrix[self.line[self.place[chosen]], self.owner[chosen]] = self.tf[chosen]
        rest = np.flatnonzero(~inside)
        rest = rest[np.argsort(self.place[rest], kind="stable")]
        self.listed, self.listed_tf = self.owner[rest], self.tf[rest]
        self.starts = np.concatenate([[0], np.cumsum(np.where(frequent, 0, self.df))])

    def hits(self, terms: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the candidates' grams those that the block has: candidate, place among the block's grams, count."""
        g = np.concatenate([g for g, _ in terms])
        at = np.minimum(np.searchsorted(self.grams, g), max(0, len(self.grams) - 1))
        ok = self.grams[at] == g if len(self.grams) else np.zeros(len(g), bool)
        row = np.repeat(np.arange(len(terms), dtype=np.int32), [len(g) for g, _ in terms])
        return row[ok], at[ok], np.concatenate([n for _, n in terms])[ok]

    def steps(self, row: np.ndarray, at: np.ndarray, rows: int) -> Iterator[tuple[int, int, slice]]:
        """Runs of candidates, and their hits, whose arrays are of about ``CELLS`` cells or have one candidate."""
        ends = np.searchsorted(row, np.arange(rows + 1))
        cost = np.concatenate([[0], np.cumsum(self.starts[at + 1] - self.starts[at])])[ends]
        width, k = max(1, CELLS // max(1, self.n, self.lines)), 0
        while k < rows:
            to = max(k + 1, min(k + width, int(np.searchsorted(cost, cost[k] + CELLS, "right")) - 1, rows))
            yield k, to, slice(ends[k], ends[to])
            k = to

    def dense(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Sums of ``value`` times the references' counts, of the frequent grams."""
        line = self.line[at]
        ok = line >= 0
        return np.bincount(row[ok].astype(np.int64) * self.lines + line[ok], value[ok], rows * self.lines).reshape(rows, self.lines).astype(np.float32) @ self.matrix

    def sparse(self, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
        """Of the other grams, for each hit and reference: the cell and the place of the lists; and what repeats values of the hits for them."""
        n = self.starts[at + 1] - self.starts[at]
        ok = np.flatnonzero(n)
        row, at, n = row[ok], at[ok], n[ok]
        place = np.repeat(self.starts[at] - np.cumsum(n) + n, n)
        place += np.arange(len(place))
        cell = np.repeat(row.astype(np.int64) * self.n, n)
        cell += self.listed[place]
        return cell, place, lambda value: np.repeat(value[ok], n)


class Measure(NamedTuple):
    """A measure of candidates and references: the grams' sizes, how a text is prepared, and what gives a candidate's largest value."""

    name: str
    sizes: tuple[int, ...]
    prepare: Callable[[str], str]
    largest: Callable
    #: Whether it needs the document frequencies of grams.
    weighed: bool = False


def read(path: str, b: int, category: str, *columns: str) -> Iterator[tuple]:
    """The staged blocks of a category, one at a time."""
    found = False
    for file in opened(f"{path}/b={b}"):
        for batch in pq.ParquetFile(file).iter_batches(1, columns=["category", *columns]):
            if batch.num_rows and batch.column(0)[0].as_py() == category:
                found = True
                yield tuple(c[0].as_py() for c in batch.columns[1:])
    if not found:
        raise FileNotFoundError(f"{path}: no references of {category}")


def largest(candidates: DataFrame, references: DataFrame, *measures: Measure) -> DataFrame:
    """``id`` and the largest value of each measure, in one pass over the candidates' blocks.

    The plans of both sides run more than once; a dear one should be staged before.
    """
    tasks = max(64, int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.table({"category": pa.array([key[0].as_py()]), "b": pa.array([key[1].as_py()], pa.int32()), "texts": pa.array([once(rows)[1]], pa.list_(pa.string()))})

    made = placed(references, REFERENCES).groupBy("category", "b", "i").applyInArrow(block, "category string, b int, texts array<string>")
    kept, path = staged(made, "references", "b")
    weights = [staged_frequencies(kept, path, m, tasks) if m.weighed else "" for m in measures]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        category, b = key[0].as_py(), key[1].as_py()
        ids, texts = once(rows)
        found = {"id": pa.array(ids, pa.string())}
        for k, m in enumerate(measures):
            blocks = (Block([m.prepare(t) for t in own], m.sizes) for (own,) in read(path, b, category, "texts"))
            frequencies = read(weights[k], b, category, "docs", "grams", "counts") if m.weighed else None
            found[m.name] = pa.array(m.largest(counted([m.prepare(t) for t in texts], m.sizes), blocks, frequencies))
        return pa.table(found)

    rows = placed(candidates, CANDIDATES, kept.select("category").distinct(), tasks).groupBy("category", "b", "i")
    best = rows.applyInArrow(run, "id string" + "".join(f", {m.name} double" for m in measures)).groupBy(F.col("id").alias("_id")).agg(*[F.max(m.name).alias(m.name) for m in measures])
    ids = candidates.select("id").distinct()
    return ids.join(best, F.col("id").cast("string") == F.col("_id"), "left").select("id", *[F.coalesce(m.name, F.lit(0.0)).alias(m.name) for m in measures])


def staged_frequencies(kept: DataFrame, path: str, m: Measure, tasks: int) -> str:
    """Where the document frequencies of the grams of each category of the staged references are, once a category; in parts."""

    def of_blocks(category: str, b: int) -> Iterator[tuple]:
        for (texts,) in read(path, b, category, "texts"):
            g, n = np.unique(np.concatenate([g for g, _ in counted([m.prepare(t) for t in texts], m.sizes)]), return_counts=True)
            yield len(texts), g.tobytes(), n.astype(np.int32).tobytes()

    def count(key: tuple, _: pa.Table) -> pa.Table:
        category, b = key[0].as_py(), key[1].as_py()
        docs, grams, counts = document_frequencies(of_blocks(category, b))
        parts = range(0, max(1, len(grams)), CELLS)
        cut = lambda x: pa.array([x[a : a + CELLS].tobytes() for a in parts], pa.binary())
        return pa.table({"category": pa.array([category] * len(parts)), "b": pa.array([b] * len(parts), pa.int32()), "docs": pa.array([docs if a == 0 else 0 for a in parts]), "grams": cut(grams), "counts": cut(counts)})

    made = kept.select("category", "b").repartition(tasks, "category", "b").groupBy("category", "b").applyInArrow(count, "category string, b int, docs long, grams binary, counts binary")
    return staged(made, "frequencies", "b")[1]


def overlaps(candidates: DataFrame, references: DataFrame, n: int = 4) -> DataFrame:
    """``id, overlap``: the largest share of a candidate's distinct ``n``-grams that one reference of its category has.

    Spaces and line feeds are left out. 0 where there are no references or no grams. Long texts are compared whole.
    """
    return largest(candidates, references, overlap_measure(n))


def overlap_measure(n: int = 4) -> Measure:
    return Measure("overlap", (n,), squeeze, most_shared)


def most_shared(terms: list, blocks: Iterator[Block], _: None) -> np.ndarray:
    best = np.zeros(len(terms))
    for block in blocks:
        block.tf[:], block.listed_tf[:] = 1, 1
        block.matrix = (block.matrix > 0).astype(np.float32)
        for at in range(0, len(terms), ROWS):
            some = terms[at : at + ROWS]
            row, place, _ = block.hits(some)
            for a, z, part in block.steps(row, place, len(some)):
                r, p = row[part] - a, place[part]
                both = block.dense(r, p, np.ones(len(p)), z - a)
                cell, _, _ = block.sparse(r, p)
                both += np.bincount(cell, minlength=both.size).reshape(both.shape)
                best[at + a : at + z] = np.maximum(best[at + a : at + z], both.max(axis=1))
    return best / np.maximum(1, [len(g) for g, _ in terms])


def cosines(candidates: DataFrame, references: DataFrame, sizes: tuple[int, int] = (2, 3)) -> DataFrame:
    """``id, cosine``: the largest cosine of a candidate and a reference of its category in TF-IDF space.

    The space is that of the candidate and all references of its category: smooth idf, raw counts, Euclidean norm; lower case,
    runs of white space as one space. As only one document changes from candidate to candidate, the idf of a gram has two values,
    with and without the candidate, and a reference's norm is its own plus a correction over the grams it shares. 0 without
    references.
    """
    return largest(candidates, references, cosine_measure(sizes))


def cosine_measure(sizes: tuple[int, int] = (2, 3)) -> Measure:
    return Measure("cosine", tuple(range(sizes[0], sizes[1] + 1)), fold, largest_cosine, True)


def document_frequencies(parts: Iterator[tuple]) -> tuple[int, np.ndarray, np.ndarray]:
    """The documents, the grams, and in how many documents each is, from those of the blocks."""
    docs, grams, counts, waiting, size = 0, np.empty(0, np.int64), np.empty(0, np.int32), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        g, at = np.unique(np.concatenate([grams, *[g for g, _ in waiting]]), return_inverse=True)
        return g, np.bincount(at, np.concatenate([counts, *[n for _, n in waiting]]), len(g)).astype(np.int32)

    for n, g, df in parts:
        docs += n
        waiting.append((np.frombuffer(g, np.int64), np.frombuffer(df, np.int32)))
        size += len(waiting[-1][0])
        if size > len(grams) + 1_000_000:
            (grams, counts), waiting, size = merged(), [], 0
    return docs, *merged()


def largest_cosine(terms: list, blocks: Iterator[Block], parts: Iterator[tuple]) -> np.ndarray:
    """The largest cosines: from each block the references that may have them, by single precision and a bound, then their exact values."""
    docs, grams, counts = document_frequencies(parts)
    weight = lambda df, more: (np.log((2 + docs) / (1 + df + more)) + 1) ** 2

    def frequency(g: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(grams, g), max(0, len(grams) - 1))
        return np.where(grams[at] == g, counts[at], 0) if len(grams) else np.zeros(len(g))

    best = np.zeros(len(terms))
    norm = np.concatenate([_norms(terms[at : at + ROWS], frequency, weight) for at in range(0, len(terms), ROWS)] or [best])
    for block in blocks:
        df = frequency(block.grams)
        w1, w0 = weight(df, 1), weight(df, 0)
        less = w0 - w1  # by which a shared gram lowers a reference's squared norm, times the square of its count
        square = block.tf.astype(float) ** 2
        base = np.bincount(block.owner, square * w0[block.place], block.n)
        lowered = square * less[block.place]
        of_dense, of_all = np.bincount(block.owner, lowered * (block.line[block.place] >= 0), block.n), np.bincount(block.owner, lowered, block.n)
        scale = np.where(base > 0, 1 / np.sqrt(np.where(base > 0, base, 1)), 0)
        block.matrix *= scale.astype(np.float32)
        lists, drops_of = block.listed_tf * scale[block.listed], block.listed_tf.astype(float) ** 2
        # what the cosine may gain at most where a candidate has all grams of a reference, or all frequent ones
        least = np.maximum(base - of_all, 1e-300)
        gain, gain_dense = np.sqrt(np.maximum(1.0, base / least)).astype(np.float32), np.sqrt(np.maximum(1.0, (least + of_dense) / least))
        values, drops = np.zeros(len(block.grams)), np.zeros(len(block.grams))
        for at in range(0, len(terms), ROWS):
            some = terms[at : at + ROWS]
            row, place, n = block.hits(some)
            for a, z, part in block.steps(row, place, len(some)):
                r, p = row[part] - a, place[part]
                m = n[part] * w1[p]
                low = block.dense(r, p, m, z - a)  # too small by what shared grams lower, and by rounding
                cell, listed, spread = block.sparse(r, p)
                low += np.bincount(cell, spread(m) * lists[listed], low.size).reshape(low.shape)
                slack = 1 - 4e-5 - 2.4e-7 * np.bincount(r, minlength=z - a)
                floor = np.maximum(best[at + a : at + z], low.max(axis=1)) * slack
                may = low * gain >= np.maximum(floor, 1e-30).astype(np.float32)[:, None]
                who, which = np.nonzero(may)
                if not len(who):
                    continue
                # of these, what the grams in lists lower, and what the frequent ones may
                flat = who * block.n + which
                own = may.ravel()[cell]
                drop = np.bincount(np.searchsorted(flat, cell[own]), spread(less[p])[own] * drops_of[listed[own]], len(flat))
                nearer = low.ravel()[flat] / np.sqrt(np.maximum(1e-12, 1 - drop * scale[which] ** 2))
                np.maximum.at(floor, who, nearer * slack[who])
                keep = nearer * gain_dense[which] >= floor[who]
                bounds = np.searchsorted(r, np.arange(z - a + 1))
                for k, mine in zip(*_runs(who[keep], which[keep])):
                    own = slice(bounds[k], bounds[k + 1])
                    values[p[own]], drops[p[own]] = m[own], less[p[own]]
                    for j in mine:
                        e = slice(block.ends[j], block.ends[j + 1])
                        tf, has = block.tf[e].astype(float), block.place[e]
                        exact = (values[has] @ tf) / np.sqrt(max(base[j] - (drops[has] * tf) @ tf, 1e-300))
                        best[at + a + k] = max(best[at + a + k], exact)
                    values[p[own]], drops[p[own]] = 0, 0
    return np.where(norm > 0, best / np.sqrt(np.where(norm > 0, norm, 1)), 0.0)


def _norms(terms: list, frequency: Callable, weight: Callable) -> np.ndarray:
    """Squared norms of candidates."""
    row = np.repeat(np.arange(len(terms)), [len(g) for g, _ in terms])
    return np.bincount(row, np.concatenate([n for _, n in terms]).astype(float) ** 2 * weight(frequency(np.concatenate([g for g, _ in terms])), 1), len(terms))


def _runs(who: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each candidate of a sorted list and what belongs to it."""
    k, first = np.unique(who, return_index=True)
    return k, np.split(which, first[1:]) if len(k) else []


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of the same length; 0 where one is zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    both = norm(a) * norm(b)
    return F.when(both > 0, dot / both).otherwise(F.lit(0.0))
