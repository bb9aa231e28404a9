"""Problem 2: check each new batch for duplicates of anything that came before, without going through the history anew.

The index persists, of each distinct text ever taken in, the keys of its minwise subsets, packed in buckets by hash of the key with
the text's size and print, and once the text itself. A batch probes bucket by bucket: both sides of a bucket lie in the same place,
the history is neither shuffled nor sorted, and only pairs that share a key and have plausible prints leave it. These are verified by
their exact sets; only their rows are taken from the stored texts. What a batch adds becomes part of the history
by a marker written last, so that a batch that failed halfway leaves nothing behind and is taken again as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsumugi.llm.codes import mix
from tsumugi.llm.common import exists, few, listed, mark, new_folder, only, remove, stage, unstage
from tsumugi.llm.shingles import CHOSEN, ELEMENTS, LEAST_CHARS, OTHERS, PRINTS, ROWS, chunked, compact, compared, likely, plausible, prints, samples, subset_keys, texts_of

#: Keys of a text: those of its subsets and that of its whole.
OWN_KEYS = ELEMENTS // CHOSEN + 1
#: Rows of a key's two lists that one task crosses.
TILE = 1024
#: Pairs for each row of a key's two lists that are held against each other where the key is found, and that come out of it, at most.
CROSSED, LIGHT = 256, 4
#: Pairs held against each other at once.
STEP = 1 << 17
#: Texts in a file, about.
FILE_ROWS = 50_000
#: A row with a text stands for so many narrow ones.
WIDE = 20
TEXT_KEY = ["salt", "h1", "h2"]
TEXTS = "id long, size int, " + "".join(f"{p} long, " for p in PRINTS) + "text string"
SIGNED = f"{TEXTS}, keys binary"
FOUND, MEMBERS = "a long, b long, similarity double", "id long, rep long"
KEYS = "bucket int, load int, base long, ids binary, sizes binary, prints binary, counts binary, keys binary"
PACKED = [c.split()[0] for c in KEYS.split(", ")]


class History:
    """A growing index of samples. Each delivery is taken in once, under the number of its load, in ascending order.

    The number of buckets is for the size the history will have: a bucket's keys (four bytes each), and 30 to 37 bytes for each text that has any there, must fit into a task.
    """

    def __init__(self, spark: SparkSession, buckets: int = 6, folder: str | None = None) -> None:
        """Open the index in ``folder``, a folder all executors share; a new one where there is none or ``folder`` isn't given.

        An index is opened with the number of buckets it was made with.
        """
        self.spark, self.buckets = spark, buckets
        self.folder, self.keys = folder or new_folder(spark, "history"), f"tsumugi_keys_{uuid.uuid4().hex}"
        spark.sql(f"create table {self.keys} ({KEYS}, take long) using parquet clustered by (bucket) into {buckets} buckets location '{self.folder}/keys'")
        # of each bucket a number that Spark's hash puts there
        placed = spark.range(64 * buckets).select(F.col("id").cast("int").alias("n")).groupBy(F.pmod(F.hash("n"), F.lit(buckets)).alias("b")).agg(F.min("n").alias("n"))
        self.numbers = np.array([r["n"] for r in placed.orderBy("b").collect()], np.int32)

    def close(self, delete: bool = False) -> None:
        """Forget the table; the files stay for the next time. ``delete``: only what was found in it stays."""
        self.spark.sql(f"drop table if exists {self.keys}")
        for kind in ("keys", "texts", "taken") if delete else ():
            remove(self.spark, f"{self.folder}/{kind}")

    def taken(self) -> dict[int, tuple[int, str]]:
        """Of each load that has become part of the history its take, and the name under which it was signed."""
        return {int(load): (int(take), name) for load, take, name in sorted(n.split("-") for n in listed(self.spark, f"{self.folder}/taken"))}

    def take(self, batch: DataFrame, load: int) -> DataFrame:
        """``id, first_id, similarity``: rows of ``batch`` (``id, category, text``) that repeat a sample of a smaller load.

        ``first_id`` is an earlier sample of the same category with a similar text; not always the earliest. Rows with null
        category or text and texts too short are never repeats and aren't indexed; repeated rows of an id count once. A load that
        was taken before gives what was found then.
        """
        if load not in self.taken():
            folder = self.sign(batch.select("id", F.lit(load).alias("load"), "category", "text"))
            self.take_signed(folder, load)
            remove(self.spark, folder)
        return self.found([load])

    def sign(self, samples: DataFrame) -> str:
        """Make samples (``id, load, category, text``) ready to be taken in, whatever the history has; returns their folder.

        In it, by load, are the distinct texts with their prints and keys, and which ids have each text.
        """
        folder = new_folder(self.spark, "signed")
        rows = samples.where(F.col("load").isNotNull() & F.col("category").isNotNull() & (F.length("text") >= LEAST_CHARS)).select(F.col("id").cast("long").alias("id"), F.col("load").cast("int").alias("load"), F.xxhash64("category").alias("salt"), "text")
        light = rows.select("id", "load", "salt", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
        reps = stage(light.groupBy("load", *TEXT_KEY).agg(F.min("id").alias("rep")), "reps")
        members = light.join(reps, ["load", *TEXT_KEY]).select("id", "rep", "load").distinct()
        members.write.partitionBy("load").parquet(f"{self.folder}/members/{folder.rsplit('/', 2)[1]}")
        one = rows.join(reps.withColumnRenamed("rep", "id"), ["id", "load", "salt"]).dropDuplicates(["id", "load", "salt"])
        _signed(one).write.partitionBy("load").parquet(folder)
        unstage(reps)
        return folder

    def take_signed(self, folder: str, load: int) -> None:
        """Hold a load of a folder of ``sign`` against the history, and add to it what isn't in it; all or nothing."""
        take, earlier = uuid.uuid4().int >> 66, [t for other, (t, _) in self.taken().items() if other < load]
        path, found_at = f"{folder}/load={load}", f"{self.folder}/found/take={take}"
        signed = self.spark.read.schema(SIGNED).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], SIGNED)
        fresh, n = signed, signed.count()
        own = _packed(signed, self.numbers).withColumns({"load": F.lit(load), "take": F.lit(take)}).select(*PACKED, "take")
        own.repartition(self.buckets, "bucket").write.mode("append").format("parquet").bucketBy(self.buckets, "bucket").option("path", f"{self.folder}/keys").saveAsTable(self.keys)
        if earlier:
            index, texts = self.spark.table(self.keys), self._texts(earlier)
            work = new_folder(self.spark, "work")
            met = stage(_met(index.where(F.col("take").isin(earlier)), index.where(F.col("take") == take)), "met", work)
            _similar(met, signed, n, texts, work).write.parquet(found_at)
            remove(self.spark, work)
            # of texts with the same grams one is enough to find whatever is similar; keys of the others lead nowhere
            copies = self.spark.read.schema(FOUND).parquet(found_at).where("similarity = 1").select(F.col("a").alias("id")).distinct()
            fresh = signed.join(few(copies, n), "id", "left_anti")
        else:
            self.spark.createDataFrame([], FOUND).write.parquet(found_at)
        fresh.drop("keys").coalesce(1 + n // FILE_ROWS).write.parquet(f"{self.folder}/texts/take={take}")  # few files, as each later take opens them all
        mark(self.spark, f"{self.folder}/taken/{load}-{take}-{folder.rsplit('/', 2)[1]}")

    def found(self, loads: list[int]) -> DataFrame:
        """``id, first_id, similarity`` of the loads, as taken."""
        taken = self.taken()
        pairs = self.spark.read.schema(FOUND).parquet(*[f"{self.folder}/found/take={taken[load][0]}" for load in loads])
        best = pairs.groupBy("a").agg(F.min(F.struct("b", "similarity")).alias("x"))
        paths = [path for load in loads if exists(self.spark, path := f"{self.folder}/members/{taken[load][1]}/load={load}")]
        members = self.spark.read.schema(MEMBERS).parquet(*paths) if paths else self.spark.createDataFrame([], MEMBERS)
        return members.join(best.withColumnRenamed("a", "rep"), "rep").groupBy("id").agg(F.min("x").alias("x")).select("id", F.col("x.b").alias("first_id"), "x.similarity")

    def _texts(self, takes: list[int]) -> DataFrame:
        return self.spark.read.schema(TEXTS).parquet(*[f"{self.folder}/texts/take={t}" for t in takes])


def _similar(met: DataFrame, signed: DataFrame, rows: int, texts: DataFrame, work: str) -> DataFrame:
    """``a, b, similarity``: of new texts ``a``, so many ``rows``, similar ones ``b`` of the history, some at least for each that has any.

    Each text meets the earliest one of each of its keys, and the others where a key's lists are short. Only texts still without a
    partner meet those of long lists, so that a large group of near copies isn't paired with itself. The pair of a text and its
    copy is always found.
    """
    n = {r["kind"]: r["count"] for r in met.groupBy("kind").count().collect()}
    first = _verified(met.where("kind = 0").select("a", "b").distinct(), n.get(0, 0), signed, texts, work)
    if 1 not in n:
        return first
    first = stage(first, "first", work)
    tiles = met.where("kind = 1").select("tile", "a").join(met.where("kind = 2").select("tile", "b"), "tile").select("a", "b")
    left = _plausible(tiles.join(few(first.select("a").distinct(), rows), "a", "left_anti"), signed, rows, texts, work)
    return first.unionByName(_verified(left, left.count(), signed, texts, work))


def _signed(rows: DataFrame) -> DataFrame:
    """``SIGNED`` and ``load`` of ``rows`` (``id, load, salt, text``) with a gram; the last key is that of the text without white space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, ROWS):
            sample, sizes, whole = samples([compact(t) for t in texts_of(batch.column(3))])
            salt = batch.column(2).to_numpy().view(np.uint64)
            keys = np.column_stack([subset_keys(sample, salt).view(np.uint64), mix(mix(salt ^ whole[:, 0]) ^ whole[:, 1])])
            made = [batch.column(0), pa.array(sizes.astype(np.int32)), *map(pa.array, prints(sample).T), batch.column(3), pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(made, names=[*(c.split()[0] for c in SIGNED.split(", ")), "load"]).filter(pa.array(sizes > 0))

    return rows.select("id", "load", "salt", "text").mapInArrow(run, f"{SIGNED}, load int")


def _packed(signed: DataFrame, numbers: np.ndarray) -> DataFrame:
    """``PACKED`` without ``load``: of each batch of texts the keys of each bucket, four bytes each, and the texts that have any there.

    ``counts`` has the number of keys of each of these texts, which follow each other. Ids are stored as differences from ``base``,
    in as few bytes as the largest needs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not (n := batch.num_rows):
                continue
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint64)
            bucket = ((keys >> np.uint64(32)) % np.uint64(len(numbers))).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            low, cuts = keys.astype(np.uint32)[order], np.searchsorted(bucket[order], np.arange(len(numbers) + 1)).tolist()
            ids, sizes, marks = batch.column("id").to_numpy(), batch.column("size").to_numpy(), np.column_stack([batch.column(p).to_numpy() for p in PRINTS])
            base = ids.min()
            ids = (ids.view(np.uint64) - base.view(np.uint64)).astype(np.min_scalar_type(int(ids.max()) - int(base)))
            parts = []
            for a, b in zip(cuts, cuts[1:]):
                counts = np.bincount(order[a:b] // OWN_KEYS, minlength=n)
                own = np.flatnonzero(counts)
                parts.append([x.tobytes() for x in (ids[own], sizes[own], marks[own], counts[own].astype(np.uint8), low[a:b])])
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array([int(base)] * len(parts), pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*parts))], names=[c for c in PACKED if c != "load"])

    return signed.select("id", "size", *PRINTS, "keys").mapInArrow(run, KEYS.replace("load int, ", ""))


def _unpacked(side: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """Load, keys, and the place of each key's text among the row's texts; ids, sizes and prints of these, of each packed row."""
    for batch in side.to_batches():
        for load, base, *packed in zip(*(batch.column(c) for c in PACKED[1:])):
            ids, sizes, marks, counts, keys = (x.as_buffer() for x in packed)
            counts = np.frombuffer(counts, np.uint8)
            if n := len(counts):
                texts = np.frombuffer(ids, f"u{len(ids) // n}").astype(np.int64) + base.as_py(), np.frombuffer(sizes, np.int32), np.frombuffer(marks, np.uint64).reshape(n, -1)
                yield load.as_py(), np.frombuffer(keys, np.uint32), np.repeat(np.arange(n), counts), texts


def _lists(old: pa.Table, new: pa.Table) -> tuple | None:
    """The keys both sides of a bucket have: starts and lengths of their lists of new and of old texts, these lists, and the texts of either side.

    Old texts of a key are in the order they came in. A bit for each key of the batch leaves out nearly all keys of the history.
    """
    mine = list(_unpacked(new))
    if not mine or not old.num_rows:
        return None
    keys, own = np.concatenate([k for _, k, _, _ in mine]), _joined([x for _, _, *x in mine])
    order = np.lexsort((own[1][0][own[0]], keys))
    keys, ours = keys[order], own[0][order]
    first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ours[1:] != ours[:-1])])
    keys, ours = keys[first], ours[first]
    values, starts, sizes = np.unique(keys, return_index=True, return_counts=True)
    low = np.uint32((1 << (16 * len(values) - 1).bit_length()) - 1 & 0xFFFFFFFF)
    has = np.zeros(int(low) + 1, bool)
    has[values & low] = True
    hits, met = [], []
    for load, k, place, texts in _unpacked(old):
        maybe = np.flatnonzero(has[k & low])
        at = np.minimum(np.searchsorted(values, k[maybe]), len(values) - 1)
        ok = values[at] == k[maybe]
        used, place = np.unique(place[maybe[ok]], return_inverse=True)
        hits.append((at[ok], np.full(len(place), load)))
        met.append((place, tuple(x[used] for x in texts)))
    at, loads = (np.concatenate(x) for x in zip(*hits))
    if not len(at):
        return None
    place, texts = _joined(met)
    order = np.lexsort((texts[0][place], loads, at))
    both, old_starts, old_sizes = np.unique(at[order], return_index=True, return_counts=True)
    return starts[both], sizes[both], ours, own[1], old_starts, old_sizes, place[order], texts


def _joined(parts: list) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Places among texts, and texts, of several packed rows as of one."""
    before = np.cumsum([0, *(len(texts[0]) for _, texts in parts)])
    return np.concatenate([place + n for (place, _), n in zip(parts, before.tolist())]), tuple(map(np.concatenate, zip(*(texts for _, texts in parts))))


def _met(old: DataFrame, new: DataFrame) -> DataFrame:
    """``kind, tile, a, b``: ids of the batch and of the history that share a key.

    Kind 0: pairs with plausible prints, of each text with the first one of the history that has the key, and with the others if the
    key's lists are short enough and few of their pairs are plausible. Other lists come out as tiles, kind 1 their ids of the batch and
    kind 2 those of the history, so that a hot key is spread and what leaves a bucket is no longer than the lists, or ``LIGHT`` times.
    """

    def meet(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
        parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        if (found := _lists(old, new)) is not None:
            starts, sizes, ours, own, old_starts, old_sizes, theirs, texts = found
            none = lambda x: np.zeros(len(x), np.int64)
            rest = old_sizes - 1
            _, a, b = _crossed(sizes, starts, sizes, ours, own, old_starts, np.ones_like(rest), theirs, texts)
            pairs = [(a, b)]
            light = rest * sizes <= CROSSED * (sizes + rest)
            kept, a, b = _crossed(LIGHT * (sizes + rest)[light], starts[light], sizes[light], ours, own, old_starts[light] + 1, rest[light], theirs, texts)
            light[np.flatnonzero(light)[~kept]] = False
            pairs.append((a, b))
            parts.append((0, *_pairs(*(ids[np.concatenate(x)] for ids, x in zip((own[0], texts[0]), zip(*pairs))))))
            for k in np.flatnonzero(~light).tolist():
                left, right = own[0][ours[starts[k] : starts[k] + sizes[k]]], texts[0][theirs[old_starts[k] + 1 : old_starts[k] + old_sizes[k]]]
                for x in range(0, len(left), TILE):
                    for y in range(0, len(right), TILE):
                        number = np.int64(key[0].as_py()) << 40 | len(parts)
                        a, b = left[x : x + TILE], right[y : y + TILE]
                        parts += [(1, np.full(len(a), number), a, none(a)), (2, np.full(len(b), number), none(b), b)]
        columns = [np.concatenate([np.full(len(p[1]), p[0], np.int32) for p in parts] or [np.empty(0, np.int32)]), *(np.concatenate([p[c] for p in parts] or [np.empty(0, np.int64)]) for c in (1, 2, 3))]
        return pa.table(dict(zip(("kind", "tile", "a", "b"), map(pa.array, columns))))

    return old.select(*PACKED).groupBy("bucket").cogroup(new.select(*PACKED).groupBy("bucket")).applyInArrow(meet, "kind int, tile long, a long, b long")


def _crossed(most: np.ndarray, s: np.ndarray, n: np.ndarray, ours: np.ndarray, own: tuple, t: np.ndarray, m: np.ndarray, theirs: np.ndarray, texts: tuple) -> tuple[np.ndarray, ...]:
    """Of keys with lists from ``s`` and ``t`` on, ``n`` and ``m`` long: whether ``most`` pairs at most of a key are plausible, and those of such keys."""
    ends, count = np.cumsum(n * m), np.zeros(len(n), np.int64)
    begins, out = ends - n * m, []
    for x in range(0, int(ends[-1]) if len(ends) else 0, STEP):
        key = np.arange(np.searchsorted(ends, x, "right"), np.searchsorted(begins, x + STEP, "left"))
        key = key[count[key] <= most[key]]
        low = np.maximum(begins[key], x)
        pairs = np.minimum(ends[key], x + STEP) - low
        k = np.repeat(key, pairs)
        place = np.arange(len(k)) + np.repeat(low - begins[key] - (np.cumsum(pairs) - pairs), pairs)
        a, b = ours[s[k] + place // m[k]], theirs[t[k] + place % m[k]]
        ok = likely(own[1][a], own[2][a], texts[1][b], texts[2][b])
        k, a, b = k[ok], a[ok], b[ok]
        count += np.bincount(k, minlength=len(n))
        few_enough = (count <= most)[k]
        out.append((k[few_enough], a[few_enough], b[few_enough]))
    k, a, b = (np.concatenate(c) for c in zip(*out)) if out else [np.empty(0, np.int64)] * 3
    kept = count <= most
    return kept, a[kept[k]], b[kept[k]]


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tile 0, and each pair once."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.zeros(first.sum(), np.int64), a[first], b[first]


def _plausible(met: DataFrame, signed: DataFrame, rows: int, texts: DataFrame, work: str) -> DataFrame:
    """``a, b``, each pair once: those of ``met`` whose prints and sizes allow that they are similar."""
    own = few(signed.select(F.col("id").alias("a"), "size", *PRINTS), rows)
    pairs = stage(met.distinct().join(own, "a"), "pairs", work)
    other = texts.select(F.col("id").alias("b"), F.col("size").alias("sb"), *(F.col(p).alias(q) for p, q in zip(PRINTS, OTHERS)))
    return stage(other.join(few(pairs, pairs.count()), "b").where(plausible(F.col("size"), F.col("sb"))).select("a", "b"), "likely", work)


def _verified(pairs: DataFrame, most: int, signed: DataFrame, texts: DataFrame, work: str) -> DataFrame:
    """``a, b, similarity`` of the pairs, ``most`` at most, that are similar; a side is sent to the other if it is small, else both are shuffled."""
    if not most:
        return signed.sparkSession.createDataFrame([], FOUND)
    close = stage(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")).join(few(pairs, most), "b").select("a", "b", "tb"), "close", work)
    return compared(signed.select(F.col("id").alias("a"), F.col("text").alias("ta")).join(few(close, close.count() * WIDE), "a"))


def repeats(samples: DataFrame, id_col: str, load_col: str, category_col: str, text_col: str, buckets: int = 6) -> DataFrame:
    """``id, first_id, similarity``: rows that repeat one of an earlier load, each load taken in as a delivery of its own.

    Repeated rows of an id count once; ids and loads are integers; rows without a load are left out; other columns are ignored.
    """
    spark = samples.sparkSession
    index = History(spark, buckets)
    folder = index.sign(only(samples, id=F.col(id_col).cast("long"), load=F.col(load_col).cast("int"), category=category_col, text=text_col))
    loads = sorted(int(name.partition("=")[2]) for name in listed(spark, folder) if name.startswith("load="))
    for load in loads:
        index.take_signed(folder, load)
        remove(spark, f"{folder}/load={load}")
    out = index.found(loads) if loads else spark.createDataFrame([], "id long, first_id long, similarity double")
    index.close(delete=True)
    return out
