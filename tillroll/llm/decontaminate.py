"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

For every length an item has, a document's windows of that length are
fingerprinted over their word shingles.  Item fingerprints lie in a multi-index
of 4 blocks of 16 bits: a sorted table holds, for each block, the Hamming ball
of radius // 4 bits around every item's block, so that any window at most
``radius`` bits from an item meets it there (one block differs by no more than
its share).  Whole distances are counted for what the table lists, and
each pair within the radius is verified by the weighted Jaccard similarity of
the two shingle multisets, the weight of a shingle being its count.

A window without any shingle of the benchmark has similarity 0, so only windows
that hold one are fingerprinted; nothing else is left out.

Defined results: words are runs of letters and digits, lower-cased; an item with
fewer words than a shingle is one shingle; an item without words matches
nothing, nor does a null or empty text; a document shorter than an item is
compared as a whole; repeated documents or items are reported one by one; null
ids are carried; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, text_docs

WORD = re.compile(r"\w+")
BLOCKS = 4  # of 16 bits each
WINDOWS_AT_ONCE = 1 << 14
PAIRS_AT_ONCE = 1 << 20  # pairs a lookup lists before their distances are counted


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles_of(words: list[str], size: int) -> list[str]:
    """The word shingles, repeats included; fewer words than ``size`` are one shingle."""
    if len(words) <= size:
        return [" ".join(words)] if words else []
    return [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two shingle multisets."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def _votes(shingles: list[str]) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's hash."""
    from xxhash import xxh64_intdigest

    hashes = np.array([xxh64_intdigest(s) for s in shingles], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _bytes(votes: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of vote sums, as 8 bytes each."""
    return np.packbits(votes > 0, axis=1, bitorder="little")


class Fingerprints:
    """A multi-index over the fingerprints of items of one length."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.whole, self.radius = prints.view("<u8").ravel(), radius
        values = np.arange(1 << 16, dtype=np.uint16)
        ball = values[np.bitwise_count(values) <= radius // BLOCKS]
        keys, owners = [], []
        for b, block in enumerate(prints.view("<u2").T):
            near = (block[:, None] ^ ball).ravel()
            order = np.argsort(near, kind="stable")
            keys.append(near[order] + np.uint32(b << 16))
            owners.append((order // len(ball)).astype(np.int32))
        self.keys, self.owners = np.concatenate(keys), np.concatenate(owners)  # block by block, each sorted

    def within(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``seen``, position of an item) of all pairs within the radius, the nearest first."""
        whole, found = seen.view("<u8").ravel(), []
        keys = (seen.view("<u2") + (np.arange(BLOCKS, dtype=np.uint32) << 16)).ravel()
        first = np.searchsorted(self.keys, keys)
        hit = np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == keys)
        first = first[hit]
        sizes = np.searchsorted(self.keys, keys[hit], "right") - first
        before = np.cumsum(sizes) - sizes
        pieces = [slice(None)]
        if sizes.sum() > PAIRS_AT_ONCE:  # a piece starts where the pairs before it pass a multiple of the bound
            pieces = np.split(np.arange(len(hit)), np.flatnonzero(np.diff(before // PAIRS_AT_ONCE)) + 1)
        for at in pieces:
            n = sizes[at]
            w = np.repeat(hit[at] // BLOCKS, n)
            m = self.owners[np.arange(len(w)) + np.repeat(first[at] - (np.cumsum(n) - n), n)]
            apart = np.bitwise_count(whole[w] ^ self.whole[m])
            near = np.flatnonzero(apart <= self.radius)
            if len(near):
                found.append((apart[near].astype(np.int64) * len(whole) + w[near]) * len(self.whole) + m[near])
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # A pair comes from each of its blocks that is near; by distance, window and item, each once.
        pair = np.unique(np.concatenate(found)) % (len(whole) * len(self.whole))
        return pair // len(self.whole), pair % len(self.whole)


class Index:
    """One block of benchmark items: anchors, and the fingerprints of each item length."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, radius: int):
        self.shingle, self.radius = shingle, radius
        self.vocabulary: dict[str, int] = {}
        self.items = []  # (item_id, words, shingle counts)
        by_length = defaultdict(list)
        anchors = defaultdict(set)  # gram length -> tuples of word numbers
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            k = min(shingle, len(words))
            anchors[k].update(tuple(numbers[i:i + k]) for i in range(len(words) - k + 1))
            by_length[len(words)].append(len(self.items))
            self.items.append((item_id, len(words), Counter(shingles_of(words, shingle))))
        self.anchors = {k: np.unique(self._mix(np.array(sorted(v), dtype=np.uint64).T)) for k, v in anchors.items()}
        self.lengths = {n: (np.array(members), np.concatenate(
            [_bytes(_votes([*self.items[m][2].elements()]).sum(axis=0, keepdims=True)) for m in members]))
            for n, members in by_length.items()}
        self._near: dict[int, Fingerprints] = {}  # made in the tasks, where a length is first met

    def near(self, n: int) -> Fingerprints:
        if n not in self._near:
            self._near[n] = Fingerprints(self.lengths[n][1], self.radius)
        return self._near[n]

    @staticmethod
    def _mix(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def starts(self, numbers: np.ndarray, k: int) -> np.ndarray:
        """Positions at which a k-gram of the benchmark begins."""
        n = len(numbers) - k + 1
        if n <= 0 or k not in self.anchors:
            return np.empty(0, dtype=np.int64)
        known = numbers > 0
        held = known[:n].copy()
        for i in range(1, k):
            held &= known[i:i + n]
        at = np.flatnonzero(held)
        grams = self._mix([numbers[at + i] for i in range(k)])
        table = self.anchors[k]
        spot = np.minimum(np.searchsorted(table, grams), len(table) - 1)
        return at[table[spot] == grams]

    def matches(self, text: str, least: float) -> dict[int, tuple[float, int]]:
        """Item position -> (best similarity, first word) of the windows that reach ``least``."""
        words = words_of(text)
        get = self.vocabulary.get
        numbers = np.fromiter(map(get, words, repeat(0)), dtype=np.uint64, count=len(words))
        found: dict[int, tuple[float, int]] = {}
        starts = {k: at for k in self.anchors if len(at := self.starts(numbers, k))}
        for n, (members, _) in self.lengths.items() if starts else ():
            k = min(self.shingle, n)
            if k in starts:
                self._windows(words, starts[k], n, k, members, least, found)
        return found

    def _windows(self, words, anchors, n, k, members, least, found) -> None:
        size = min(n, len(words))
        last = len(words) - size
        reach = np.zeros(last + 2, dtype=np.int64)  # starts of windows that hold an anchor
        np.add.at(reach, np.clip(anchors - (size - k), 0, last), 1)
        np.add.at(reach, np.minimum(anchors, last) + 1, -1)
        at = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
        gaps = np.flatnonzero(np.diff(at) > 1) + 1
        for run in np.split(at, np.unique(np.concatenate([gaps, np.arange(WINDOWS_AT_ONCE, len(at), WINDOWS_AT_ONCE)]))):
            lo, hi = int(run[0]), int(run[-1]) + size
            grams = shingles_of(words[lo:hi], k)
            wide = size - k + 1  # shingles a window holds
            sums = np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(_votes(grams), axis=0, dtype=np.int32)])
            seen = _bytes(sums[wide:wide + len(run)] - sums[:len(run)])
            for i, j in zip(*(x.tolist() for x in self.near(n).within(seen))):
                item = int(members[j])
                if found.get(item, (0.0, 0))[0] == 1.0:  # no window can be more similar
                    continue
                score = similarity(Counter(grams[i:i + wide]), self.items[item][2])
                if score >= least and score > found.get(item, (0.0, 0))[0]:
                    found[item] = (score, lo + i)


def _indexes(benchmark: DataFrame, item_id_col: str, item_text_col: str, shingle: int, radius: int, items_at_once: int):
    """Broadcast indexes over the whole benchmark, each of about ``items_at_once`` items, dealt by a hash."""
    rows = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    blocks = max(1, math.ceil(rows.count() / items_at_once))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = Index([(r["item_id"], r["text"]) for r in part.collect()], shingle, radius)
        yield benchmark.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, least: float = 0.8,
                 radius: int = 15, items_at_once: int = 5_000) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): best window of each document and item.

    The benchmark goes to the executors in blocks of bounded size, one pass over
    the documents each; every item is used.
    """
    kept = text_docs(docs, id_col=id_col, text_col=text_col)
    fields = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                        ("start_word", pa.int64()), ("n_words", pa.int64())])
    out = None
    for shared in _indexes(benchmark, item_id_col, item_text_col, shingle, radius, items_at_once):
        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                found = [(d, index.items[i][0], score, start, index.items[i][1])
                         for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
                         for i, (score, start) in sorted(index.matches(t, least).items())]
                columns = list(zip(*found)) or [[]] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

        found = kept.mapInArrow(run, "doc_id long, item_id long, similarity double, start_word long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", shingle: int = 5, least: float = 0.8, radius: int = 15,
                   items_at_once: int = 5_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window similar to an item."""
    for shared in _indexes(benchmark, item_id_col, item_text_col, shingle, radius, items_at_once):
        def change(shared=shared):
            index = shared.value
            return lambda batch, texts: batch.filter(
                pa.array([not index.matches(t or "", least) for t in texts], pa.bool_()))

        docs = map_batches(docs, change, text_col=text_col)
    return docs
