"""Problem 8: evaluation texts in a training corpus, by latent semantic retrieval.

Texts are compared without anything but letters and digits, in NFKC and lower case. Passages are two neighbouring blocks of
``SPAN`` characters, so that each stretch of ``SPAN`` lies in one. Terms are the trigrams of the items. Document frequencies come
from all documents, the latent space from a distributed randomised SVD of the TF-IDF rows of a bounded sample of passages and of
all item windows. Passages are retrieved by their largest cosine with a window of a piece of an item; those from ``CLOSE`` on are
checked for a longest common subsequence and the piece's answers (numbers and names). Of these conditions the answers of a
piece, which all its passages in a document need, are tested first. Verbatim stretches of retrieved passages are confirmed
exactly; so that none is lost to a low cosine, each other stretch of ``SPAN`` characters is looked up among those of the items too,
and ``retrieved`` tells which way a document and item came.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsumugi.llm.codes import Rolling, gram_hashes, inside, mix
from tsumugi.llm.common import chunked, only, stage, texts_of

SPAN, TERM, RANK, EXTRA, ROUNDS = 40, 3, 64, 8, 2
#: Passages this close to an item in the latent space are checked for a paraphrase: share of the piece in its longest common subsequence with the text around, and of its answers.
CLOSE, LCS_SHARE, ANSWER_SHARE = 0.7, 0.75, 0.6
#: Passages this close are retrieved for verbatim stretches, which may be half of them.
CLOSE_VERBATIM = 0.5
#: Longer items are searched for in pieces of so many letters and digits, half of which overlap the next.
PIECE = 160
#: Passages the latent space is fitted on, at most about; items of one broadcast.
FIT_PASSAGES, ITEM_BLOCK, SLOTS = 20_000, 2000, 1 << 20
ROWS = 100
FOUND = "doc long, item long, cosine double, lcs_share double, answer_share double, verbatim boolean, retrieved boolean"


@lru_cache(1)
def letters_and_digits() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)])


def bare(text: str) -> str:
    """Letters and digits of ``text`` in NFKC and lower case."""
    return bare_points([text])[0].tobytes().decode("utf-32-le", "surrogatepass")


def bare_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the bare texts, and the offsets of the texts in them."""
    folded = [t.lower() if t.isascii() else _folded(t) for t in texts]
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = letters_and_digits()[points]
    ends = np.cumsum([0, *map(len, folded)])
    return points[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def _folded(text: str) -> str:
    once = text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)
    lower = once.lower()
    return once if lower == once else unicodedata.normalize("NFKC", lower)


def pieces_of(length: int) -> list[tuple[int, int]]:
    """Begins and ends of an item's pieces: the whole one, or pieces of ``PIECE`` of which each overlaps the next by half."""
    if length <= PIECE:
        return [(0, length)]
    return [(a, a + PIECE) for a in sorted({*range(0, length - PIECE, PIECE // 2), length - PIECE})]


class Items:
    """What tasks need of a block of items: terms, pieces, windows, verbatim stretches, and (once fitted) the latent space."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        self.ids, self.texts = np.array(ids, np.int64), [bare(t) for t in texts]
        points, offsets = bare_points(texts)
        grams, stretches = gram_hashes(points, TERM), Rolling(points).windows(SPAN)
        terms, verbatim, of, windows, window_of, self.pieces, piece_item = [], [], [], [], [], [], []
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            terms.append(grams[a : max(a, b - TERM + 1)])
            if b - a >= SPAN:
                verbatim.append(stretches[a : b - SPAN + 1])
                of.append(np.full(b - SPAN - a + 1, k))
            for first, last in pieces_of(b - a) if b - a >= TERM else ():
                x, y = a + first, a + last
                starts = sorted({*range(x, max(x + 1, y - SPAN + 1), SPAN // 2), max(x, y - SPAN)})
                windows += [(s, min(y, s + SPAN) - TERM + 1) for s in starts]
                window_of += [len(self.pieces)] * len(starts)
                self.pieces.append(self.texts[k][first:last])
                piece_item.append(k)
        self.vocabulary = np.unique(np.concatenate(terms)) if terms else np.empty(0, np.uint64)
        self.size, self.piece_item = len(self.vocabulary), np.array(piece_item, np.int64)
        self.has = np.zeros(SLOTS, bool)
        self.has[(self.vocabulary & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        both = (np.concatenate(verbatim), np.concatenate(of)) if verbatim else (np.empty(0, np.uint64), np.empty(0, np.int64))
        order = np.argsort(both[0], kind="stable")
        self.verbatim, self.verbatim_of = both[0][order], both[1][order]
        self.marks = np.zeros(SLOTS, bool)
        self.marks[(self.verbatim & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        self.window_of = np.array(window_of, np.int64)
        self.windows = [self.terms_of(grams[a:b])[1] for a, b in windows]
        self.found_by = None
        self.answers = [frozenset(re.findall(r"[0-9]{3,}|[a-z]{4,}[0-9]*|[ァ-ヺー]{4,}", t)) for t in self.pieces]
        self.places = [places(t) for t in self.pieces]
        self.free = np.array([not x for x in self.answers], bool)

    def terms_of(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the terms of items are in ``grams``, and which they are."""
        at = np.flatnonzero(self.has[(grams & np.uint64(SLOTS - 1)).astype(np.int64)])
        index = np.searchsorted(self.vocabulary, grams[at])
        ok = self.vocabulary[np.minimum(index, max(0, self.size - 1))] == grams[at] if self.size else np.zeros(len(at), bool)
        return at[ok], index[ok].astype(np.int32)

    def held(self, stretches: np.ndarray) -> np.ndarray:
        """Which stretches (hashes) may be an item's; never false for one that is."""
        return self.marks[(stretches & np.uint64(SLOTS - 1)).astype(np.int64)]

    def fit(self, frequency: np.ndarray, documents: int, basis: np.ndarray) -> None:
        """Take the space of ``basis`` (terms by rank); weights are idf."""
        self.project = (idf(frequency, documents)[:, None] * basis).astype(np.float32)
        self.query = unit(np.array([self.project[w].sum(axis=0) for w in self.windows], np.float32).reshape(-1, basis.shape[1]))
        #: The windows of each piece, one after the other, begin here.
        self.heads = np.flatnonzero(np.concatenate([[True], self.window_of[1:] != self.window_of[:-1]])) if len(self.query) else np.empty(0, np.int64)
        self.item_heads = np.searchsorted(self.piece_item[self.window_of], np.arange(len(self.ids) + 1))

    def answered(self, texts: list[str]) -> np.ndarray:
        """Texts by pieces: whether a text has enough of the piece's answers, by one pass of an automaton over each."""
        if self.found_by is None:
            import ahocorasick

            words = sorted({a for answers in self.answers for a in answers})
            number = {a: k for k, a in enumerate(words)}
            share = np.zeros((len(words), len(self.pieces)), np.float32)
            for piece, answers in enumerate(self.answers):
                for a in answers:
                    share[number[a], piece] = 1 / len(answers)
            automaton = ahocorasick.Automaton()
            for a, k in number.items():
                automaton.add_word(a, k)
            automaton.make_automaton()
            self.found_by = (automaton if words else None, share)
        automaton, share = self.found_by
        has = np.zeros((len(texts), len(share)), np.float32)
        for k, text in enumerate(texts if automaton else ()):
            if at := {x for _, x in automaton.iter(text)}:
                has[k, [*at]] = 1
        return (has @ share >= ANSWER_SHARE - 1e-3) | self.free

    def cosines(self, passages: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Passages by the given pieces: the largest cosine of a passage and a window of the piece."""
        begin, end = self.heads[pieces], np.append(self.heads, len(self.query))[pieces + 1]
        rows = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)]) if len(pieces) else np.empty(0, np.int64)
        if not len(rows) or not len(passages):
            return np.zeros((len(passages), len(pieces)), np.float32)
        return np.maximum.reduceat(passages @ self.query[rows].T, np.concatenate([[0], np.cumsum(end - begin)[:-1]]), axis=1)

    def item_cosine(self, passage: np.ndarray, item: int) -> float:
        return float((self.query[self.item_heads[item] : self.item_heads[item + 1]] @ passage).max())


def idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    return np.log((1 + documents) / (1 + frequency)) + 1


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def blocks_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all blocks of ``SPAN`` characters of non-empty texts, and the text of each."""
    counts = -(-np.diff(offsets) // SPAN)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return offsets[:-1][owner] + (np.arange(counts.sum()) - first[owner]) * SPAN, owner


def position_terms(items: Items, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where texts have a term of the items, and which; terms lie in one text."""
    at, term = items.terms_of(gram_hashes(points, TERM))
    inner = inside(offsets, TERM, len(points))[at]
    return at[inner], term[inner]


def row_sums(rows: np.ndarray, which: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``rows[which]`` from each of ``first`` to the next; the first terms of all, then the second ones, and so on."""
    n = np.diff(first, append=len(which))
    order = np.argsort(-n, kind="stable")
    begin, left, out = first[order], -n[order], np.zeros((len(first), rows.shape[1]), rows.dtype)
    for k in range(-int(left[0])):
        m = np.searchsorted(left, -k, "left")  # so many have more than k terms
        out[:m] += rows[which[begin[:m] + k]]
    back = np.empty_like(out)
    back[order] = out
    return back


def passages_of(items: Items, at: np.ndarray, term: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks with which a passage that has terms begins, and the passages' unit vectors in the latent space."""
    if not len(at):
        return np.empty(0, np.int64), np.empty((0, items.project.shape[1]), np.float32)
    block = np.searchsorted(starts, at, "right") - 1
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    own, sums = block[first], row_sums(items.project, term, first)
    # a passage begins with each block that has terms, and with the one before in the same text
    before = own - 1
    before = before[(before >= 0) & (owner[before] == owner[own])]
    begins = np.union1d(own, before)
    out = np.zeros((len(begins), sums.shape[1]), np.float32)
    out[np.searchsorted(begins, own)] += sums
    place = np.minimum(np.searchsorted(begins, own - 1), len(begins) - 1)
    ok = (begins[place] == own - 1) & (owner[np.maximum(own - 1, 0)] == owner[own])
    out[place[ok]] += sums[ok]
    return begins, unit(out)


def _summed(df: DataFrame, width: int, kind: str) -> np.ndarray:
    """Sum of the vectors in ``df`` (``part, v``), which tasks emit in parts; the result has the size of one task's vector."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("v").to_pylist():
                x = np.frombuffer(v, kind)
                total = x.copy() if total is None else total + x
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "v"])

    out = np.zeros(width, kind)
    for part, v in df.groupBy("part").applyInArrow(add, "part int, v binary").toLocalIterator():
        out[part * PART : part * PART + PART] = np.frombuffer(bytes(v), kind)
    return out


PART = 1 << 16


def _parts(x: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for k in range(0, len(x), PART):
        yield k // PART, x[k : k + PART].tobytes()


def latent_basis(sample: DataFrame, items: Items, frequency: np.ndarray, documents: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF rows of ``sample`` (``terms``) and of the item windows, by randomised SVD.

    Tasks multiply their rows with the current vectors and back, and only the sums, terms by rank, come together.
    """
    rank = min(RANK + EXTRA, max(1, items.size))
    weight = idf(frequency, documents)
    basis = np.linalg.qr(np.random.default_rng(11).standard_normal((items.size, rank)))[0]

    def gram(rows: list[np.ndarray], basis: np.ndarray) -> np.ndarray:
        out = np.zeros((items.size, rank))
        for terms in rows:
            terms, n = np.unique(terms, return_counts=True)
            if len(terms):
                x = n * weight[terms]
                x /= np.linalg.norm(x)
                out[terms] += np.outer(x, x @ basis[terms])
        return out

    for _ in range(ROUNDS):
        shared = sample.sparkSession.sparkContext.broadcast(basis)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((items.size, rank))
            for batch in batches:
                total += gram([np.frombuffer(b, np.int32) for b in batch.column(0).to_pylist()], shared.value)
            parts = [*_parts(total.ravel())]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([v for _, v in parts], pa.binary())], names=["part", "v"])

        total = _summed(sample.mapInArrow(run, "part int, v binary"), items.size * rank, "float64").reshape(items.size, rank)
        basis, strength, _ = np.linalg.svd(total + gram(items.windows, basis), full_matrices=False)
    return basis[:, :RANK]


def places(text: str) -> dict[str, int]:
    """Where each character of ``text`` stands, as bits."""
    where: dict[str, int] = {}
    for i, c in enumerate(text):
        where[c] = where.get(c, 0) | 1 << i
    return where


def common_length(where: dict[str, int], length: int, other: str) -> int:
    """Length of the longest common subsequence of a text, given by its ``places`` and length, and ``other``; bit-parallel."""
    row = full = (1 << length) - 1
    for c in other:
        if c in where:
            hit = row & where[c]
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def _search(source: DataFrame, items: Items, paraphrases: bool) -> DataFrame:
    if not items.windows:
        return source.sparkSession.createDataFrame([], FOUND)
    sc = source.sparkSession.sparkContext
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    rate = min(1.0, FIT_PASSAGES * SPAN / max(1, chars))
    plain = sc.broadcast(items)

    def survey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(plain.value.size + 1, np.int64)
        for batch in chunked(batches, ROWS):
            it = plain.value
            points, offsets = bare_points(texts_of(batch.column(1)))
            at, term = position_terms(it, points, offsets)
            seen = np.zeros((batch.num_rows, it.size), bool)
            seen[np.searchsorted(offsets, at, "right") - 1, term] = True
            frequency[:-1] += np.count_nonzero(seen, axis=0)
            frequency[-1] += batch.num_rows
            starts, owner = blocks_of(offsets)
            docs = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            pick = np.flatnonzero(mix(docs[owner] * np.uint64(1_000_003) + starts.astype(np.uint64) - offsets[owner].astype(np.uint64), 9) < np.uint64(min(2**64 - 1, int(rate * 2**64))))
            ends = np.minimum(starts[pick] + 2 * SPAN, offsets[owner[pick] + 1])
            found = [term[a:b].tobytes() for a, b in zip(np.searchsorted(at, starts[pick]), np.searchsorted(at, ends))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([-1] * len(found), pa.int32()), pa.array(found, pa.binary())], names=["part", "v"])
        parts = [*_parts(frequency)]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([v for _, v in parts], pa.binary())], names=["part", "v"])

    surveyed = stage(source.mapInArrow(survey, "part int, v binary"), "survey")
    frequency = _summed(surveyed.where("part >= 0"), items.size + 1, "int64")
    basis = latent_basis(surveyed.where("part < 0").select("v").coalesce(4), items, frequency[:-1], int(frequency[-1]))
    items.fit(frequency[:-1], int(frequency[-1]), basis)
    fitted = sc.broadcast(items)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = fitted.value
        free = np.flatnonzero(it.free)
        for batch in chunked(batches, ROWS):
            points, offsets = bare_points(texts_of(batch.column(1)))
            starts, owner = blocks_of(offsets)
            at, term = position_terms(it, points, offsets)
            begins, vectors = passages_of(it, at, term, starts, owner)
            if not len(begins):
                continue
            doc_of, rows = owner[begins], {}
            h = Rolling(points).windows(SPAN)
            held = np.flatnonzero(inside(offsets, SPAN, len(points)) & it.held(h))
            if len(held):
                # a stretch lies in the passage that begins with its first block
                passage = np.searchsorted(begins, np.searchsorted(starts, held, "right") - 1)
                low, high = np.searchsorted(it.verbatim, h[held], "left"), np.searchsorted(it.verbatim, h[held], "right")
                met = {(int(passage[k]), item) for k in np.flatnonzero(high > low) for item in set(it.verbatim_of[low[k] : high[k]].tolist())}
                for k, item in met:
                    c, doc = it.item_cosine(vectors[k], item), int(doc_of[k])
                    old = rows.get((doc, item))
                    c = max(c, old[0]) if old else c
                    rows[doc, item] = [c, 1.0, 1.0, True, c >= CLOSE_VERBATIM]
            if paraphrases:
                whole = points.tobytes().decode("utf-32-le", "surrogatepass")
                # a document that lacks a piece's answers lacks them in each passage; this settles most pairs
                enough = it.answered([whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
                close = [(*x, free) for x in [np.nonzero(it.cosines(vectors, free) >= CLOSE)]] if len(free) else []
                bound = np.searchsorted(doc_of, np.arange(batch.num_rows + 1))
                for doc in np.flatnonzero((enough & ~it.free).any(axis=1)):
                    pieces = np.flatnonzero(enough[doc] & ~it.free)
                    row, column = np.nonzero(it.cosines(vectors[bound[doc] : bound[doc + 1]], pieces) >= CLOSE)
                    close.append((row + bound[doc], column, pieces))
                for row, column, pieces in close:
                    for k, piece in zip(row.tolist(), pieces[column].tolist()):
                        doc, item, text, answers = int(doc_of[k]), int(it.piece_item[piece]), it.pieces[piece], it.answers[piece]
                        if (old := rows.get((doc, item))) and old[3]:
                            continue
                        begin = int(starts[begins[k]])
                        near = whole[max(int(offsets[doc]), begin - len(text)) : min(int(offsets[doc + 1]), begin + 2 * SPAN + len(text))]
                        hits = sum(x in near for x in answers) / len(answers) if answers else 1.0
                        # a common subsequence has no more characters than the piece has of those around
                        if hits < ANSWER_SHARE or sum(map(set(near).__contains__, text)) < LCS_SHARE * len(text):
                            continue
                        lcs = common_length(it.places[piece], len(text), near) / max(1, len(text))
                        if lcs >= LCS_SHARE and (not old or lcs > old[1]):
                            cosine = float(it.cosines(vectors[k : k + 1], np.array([piece]))[0, 0])
                            rows[doc, item] = [cosine, lcs, hits, False, True]
            if rows:
                docs = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                keys, values = [*rows], [*rows.values()]
                yield pa.RecordBatch.from_arrays([pa.array(docs[[d for d, _ in keys]]), pa.array(it.ids[[i for _, i in keys]]), *(pa.array([v[c] for v in values]) for c in range(5))], names=["doc", "item", "cosine", "lcs_share", "answer_share", "verbatim", "retrieved"])

    return source.mapInArrow(search, FOUND)


def leaks(documents: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, paraphrases: bool = True) -> DataFrame:
    """``doc, item, cosine, lcs_share, answer_share, verbatim, retrieved``: the test items each document holds, in part or in other words.

    ``verbatim``: at least ``SPAN`` consecutive letters and digits of the item occur in the document; ``retrieved``: in a passage
    with a cosine of ``CLOSE_VERBATIM`` or more. Others are paraphrases, of the whole item or of a piece of a long one.
    Null and empty texts of either side hold nothing. Repeated rows count once; ids are integers; other columns are ignored.
    Items come in blocks of ``ITEM_BLOCK``, each with a pass of its own, which bounds what is broadcast.
    """
    source = only(documents.where(F.length(documents[doc_text]) > 0), doc=F.col(doc_id).cast("long"), text=doc_text)
    listed = only(items.where(F.length(items[item_text]) > 0), item=F.col(item_id).cast("long"), text=item_text).dropDuplicates(["item"]).orderBy("item")
    out, block = None, []

    def flush(out: DataFrame | None) -> DataFrame:
        part = _search(source, Items([i for i, _ in block], [t for _, t in block]), paraphrases)
        return part if out is None else out.unionByName(part)

    for row in listed.toLocalIterator():
        block.append((row["item"], row["text"]))
        if len(block) == ITEM_BLOCK:
            out, block = flush(out), []
    if block or out is None:
        out = flush(out)
    best = F.max(F.struct("verbatim", "lcs_share", "cosine", "answer_share", "retrieved"))
    return out.groupBy("doc", "item").agg(best.alias("x")).select("doc", "item", "x.cosine", "x.lcs_share", "x.answer_share", "x.verbatim", "x.retrieved")
