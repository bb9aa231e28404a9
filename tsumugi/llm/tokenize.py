"""Problem 7: encode a whole corpus with a byte-level BPE vocabulary.

A pair occurrence index does the merging: for all distinct words of a chunk at once, each pair of neighbouring symbols maps to
all its positions; ranks that occur are applied in ascending order, each to all its positions in one vectorised step, and only
the lists of the neighbours touched are updated. Ascending order over all words gives each word its own BPE result, since a
pair that holds a merged symbol always ranks after the merge that made it.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tsumugi.llm.codes import code_points
from tsumugi.llm.common import chunked, only, texts_of

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the split of text into words before the merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in the vocabulary file: itself if printable, else the next from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(spare)) for b in range(256)]


#: The same split for texts without the characters of ``unusual``, for the faster standard library.
USUAL_WORDS = re.compile(r""" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""").findall


@lru_cache(1)
def unusual() -> np.ndarray:
    """Marks the characters which the standard library classes otherwise than the Unicode categories L and N and white space."""
    marks = np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        marks[c] = chr(c).isalnum() != (kind[0] in "LN") or (kind[0] == "N" and kind != "Nd") or 0x1C <= c <= 0x1F
    return marks


class Numbers(dict):
    """Numbers its keys in the order of their first use."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class PairIndexBpe:
    """The merges of a vocabulary file and their vectorised application."""

    def __init__(self, path: str) -> None:
        import regex

        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.split = regex.compile(WORDS).findall
        self.first = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.none = len(merges)
        self._build_table()
        of = self.first
        self.of_bytes = self.rank(np.repeat(of, 256), np.tile(of, 256)).astype(np.uint16 if self.none < 65536 else np.int32)

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build_table(self) -> None:
        """Open addressing with linear probing over the pairs' keys."""
        key = self.left.astype(np.int64) << 32 | self.right
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(key)) * 8))))
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.ranks = np.full((1 << self.bits) + 64, self.none, np.int32)
        self.probes, at, todo = 0, self._hash(key), np.arange(len(key))
        while len(todo):
            slots = at[todo] + self.probes
            free = self.keys[slots] < 0
            _, one = np.unique(slots, return_index=True)
            win = np.zeros(len(todo), bool)
            win[one] = True
            win &= free
            self.keys[slots[win]], self.ranks[slots[win]] = key[todo[win]], todo[win]
            todo = todo[~win]
            self.probes += 1

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` where it is no merge."""
        key = a.astype(np.int64) << 32 | b
        slot = self._hash(key)
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], np.int32(self.none))
        open_ = np.flatnonzero((found != key) & (found >= 0))
        for step in range(1, self.probes):
            if not len(open_):
                break
            found = self.keys[slot[open_] + step]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]] + step]
            open_ = open_[~hit & (found >= 0)]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the offsets of the words in it."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        n = int(bounds[-1])
        octets = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.first[octets]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        full = bounds[1:][sizes > 0]
        after[full - 1] = -1
        before[bounds[:-1][sizes > 0]] = -1

        where: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(positions: np.ndarray, ranks: np.ndarray) -> None:
            keep = np.flatnonzero(ranks < self.none)
            if not len(keep):
                return
            positions, ranks = positions[keep], ranks[keep]
            order = np.argsort(ranks.astype(np.uint16) if self.none < 65536 else ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            heads = ranks[np.concatenate([[0], cuts])].tolist()
            edges = [0, *cuts.tolist(), len(ranks)]
            for k, r in enumerate(heads):
                if (lists := where.get(r)) is None:
                    where[r] = [positions[edges[k] : edges[k + 1]]]
                    heapq.heappush(heap, r)
                else:
                    lists.append(positions[edges[k] : edges[k + 1]])

        if n > 1:
            ranks = self.of_bytes[octets[:-1].astype(np.int32) << 8 | octets[1:]]
            ranks[after[:-1] < 0] = self.none
            file(np.arange(n - 1, dtype=np.int32), ranks)
            del ranks
        while heap:
            r = heapq.heappop(heap)
            lists = where.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, c = self.left[r], self.right[r], self.made[r]
            at = at[sym[at] == a]
            nxt = after[at]
            ok = (nxt >= 0) & (sym[nxt] == b)
            at, nxt = at[ok], nxt[ok]
            if a == b and len(at) > 1:  # of a run, every second pair from its start
                order = np.argsort(at)
                at, nxt = at[order], nxt[order]
                head = np.concatenate([[True], nxt[:-1] != at[1:]])
                begin = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
                even = (np.arange(len(at)) - begin) % 2 == 0
                at, nxt = at[even], nxt[even]
            if not len(at):
                continue
            beyond = after[nxt]
            sym[at] = c
            sym[nxt] = -1
            after[at] = beyond
            has = beyond >= 0
            before[beyond[has]] = at[has]
            prior = before[at]
            touched = prior >= 0
            touched[touched] = sym[prior[touched]] != c
            first, second = np.concatenate([at[has], prior[touched]]), np.concatenate([beyond[has], at[touched]])
            file(first, self.rank(sym[first], sym[second]))
        alive = sym >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])[bounds]
        return sym[alive], counts

    def words(self, texts: list[str]) -> Iterator[list[str]]:
        """The words of each text."""
        points, ends = code_points(texts)
        odd = np.concatenate([[0], np.cumsum(unusual()[points])])[ends]
        for text, some in zip(texts, np.diff(odd).tolist()):
            yield self.split(text) if some else USUAL_WORDS(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of the texts in it; each distinct word is merged once."""
        index = Numbers()
        uses = [np.array([*map(index.__getitem__, found)], np.int32) for found in self.words(texts)]
        return self.gather(index, uses)

    def gather(self, index: Numbers, uses: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return spread(*self.encode_words(list(index)), uses)


def spread(ids: np.ndarray, bounds: np.ndarray, uses: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts from those of their words."""
    use = np.concatenate(uses) if uses else np.empty(0, np.int32)
    lengths = np.diff(bounds)[use]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.arange(ends[-1]) + np.repeat(bounds[use] - ends[:-1], lengths)
    return ids[flat], ends[np.cumsum([0, *map(len, uses)])]


@lru_cache(2)
def bpe(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode_corpus(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k.json", tokenizer_dir: str = TOKENIZER_DIR, word_chars: int = 1_500_000, out_rows: int = 1000) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of each row's whole text, without special tokens.

    Null and empty texts have an empty list; strings of special tokens in a text are ordinary text; repeated rows each come
    out; an empty table gives no rows; other columns are ignored. One index covers the rows of a partition until their distinct
    words have ``word_chars`` characters, which bounds memory; then the next index begins. A single longer text is one index.
    No shuffle: rows are encoded where they are read.
    """
    path = os.path.join(tokenizer_dir, tokenizer)
    source = only(df, doc=id_col, text=text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)

        def out(docs: list, index: Numbers, uses: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            words = model.encode_words(list(index))
            for at in range(0, len(docs), out_rows):
                ids, ends = spread(*words, uses[at : at + out_rows])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(docs[at : at + out_rows], kind), lists], names=["doc", "ids"])

        docs, index, uses, size, kind = [], Numbers(), [], 0, None
        for batch in chunked(batches, out_rows):
            kind = batch.schema.field(0).type
            for doc, found in zip(batch.column(0).to_pylist(), model.words(texts_of(batch.column(1)))):
                before = len(index)
                use = np.array([*map(index.__getitem__, found)], np.int32)
                docs.append(doc)
                uses.append(use)
                if len(index) > before:
                    size += sum(len(found[k]) for k in np.flatnonzero(use >= before))
                if size >= word_chars:
                    yield from out(docs, index, uses)
                    docs, index, uses, size = [], Numbers(), [], 0
        if docs:
            yield from out(docs, index, uses)

    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(run, f"doc {kind}, ids array<int>").withColumnRenamed("doc", id_col)
