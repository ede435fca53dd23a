"""Ranked lexical search in K2-treaps over the grid of terms and documents.

The rows of the grid are the terms of the items, its columns the documents of a
chunk; a cell holds the term's whole impact on the document's score.  The grid is
a quadtree, level by level in arrays: a cell has four bits that say which quarters
hold anything, the rank of its first child, and how far its highest impact lies
below its parent's (in as few bytes as the level needs).  An item descends with
one path a term, all over the same range of documents: the sum of the paths'
maxima, times how often the item has each term, bounds the score of every
document of the range.  Ranges are opened best first, many at once, until no open
range can reach the item's k-th score; a range of one document has its score.

Documents are read twice: once for the counts of all documents and terms, once to
build the treaps, chunk by chunk, inside the tasks.  Each task returns its k best
documents an item; they are merged in two steps.  Items go to the tasks in blocks
of bounded size, two passes a block.

Defined results: a null or empty text has no terms; documents without a score
above 0 are not returned; equal scores are ranked by ascending id, a null id
last; repeated documents are ranked one by one; every item row is ranked by
itself, repeated and null ids too; an item without terms has no rows; empty tables
give no rows; whole texts are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import text_docs

# Bytes that part terms become spaces, A-Z become a-z, all else stays.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
OPEN_AT_ONCE = 256  # ranges opened in a step
PATHS_HELD = 1 << 21  # paths of open ranges beyond which the deepest are opened first
POPCOUNT = np.array([bin(x).count("1") for x in range(16)], dtype=np.int64)
FOUND = "item long, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII; A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


class Items:
    """A block of items: their distinct terms as grid rows, and each item's rows with how often it has them."""

    def __init__(self, rows: list[tuple[int, str]]):
        terms = [(number, Counter(terms_of(text))) for number, text in rows]
        self.rows = {t: i for i, t in enumerate(sorted({t for _, c in terms for t in c}))}
        self.items = [(number, c) for number, c in terms if c]

    def weigh(self, documents: int, df: dict[int, int]) -> None:
        """Order the rows by falling weight, so that a cell's rows have like impacts."""
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.rows))]
        order = sorted(range(len(weight)), key=lambda i: (-weight[i], i))
        place = {old: new for new, old in enumerate(order)}
        self.weight = np.array([weight[i] for i in order], dtype=np.int64)
        self.rows = {t: place[i] for t, i in self.rows.items()}
        self.queries = []
        for number, counts in self.items:
            rows = np.array([self.rows[t] for t in counts], dtype=np.int64)
            by = np.argsort(rows)
            self.queries.append((number, rows[by], np.array(list(counts.values()), dtype=np.int64)[by]))
        del self.items


def interleaved(x: np.ndarray) -> np.ndarray:
    """The low 31 bits of each number, a zero bit before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """A quadtree over cells (row, column, value > 0), with the maxima of its cells."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.height = max(int(max(rows.max(), columns.max())).bit_length(), 1)
        code = (interleaved(rows) << np.uint64(1)) | interleaved(columns)
        by = np.argsort(code, kind="stable")
        code, top = code[by], values[by]
        levels = [(code, top, None, None)]  # from the leaves up
        for _ in range(self.height):
            child, best = levels[-1][:2]
            parent = child >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            quarter = (np.uint8(1) << (child & np.uint64(3)).astype(np.uint8))
            levels.append((parent[first], np.maximum.reduceat(best, first), np.bitwise_or.reduceat(quarter, first), first))
        levels.reverse()
        self.highest = int(levels[0][1][0])
        self.quarters = [level[2] for level in levels[:-1]]
        self.first = [level[3].astype(np.int32) for level in levels[:-1]]
        self.below = []  # how far a cell's maximum is below its parent's
        for (_, above, bits, _), (_, own, _, _) in zip(levels, levels[1:]):
            gap = np.repeat(above, POPCOUNT[bits]) - own
            self.below.append(gap.astype(np.min_scalar_type(int(gap.max()))))

    def children(self, level: int, nodes: np.ndarray, highest: np.ndarray, row_bits: np.ndarray):
        """(nodes, maxima) in the left and in the right half of the columns; -1 and 0 where there is nothing."""
        some = nodes >= 0
        at = np.where(some, nodes, 0)
        bits = np.where(some, self.quarters[level][at], 0)
        start, gaps = self.first[level][at], self.below[level]
        halves = []
        for column_bit in (0, 1):
            quarter = 2 * row_bits + column_bit
            held = (bits >> quarter) & 1 == 1
            child = np.where(held, start + POPCOUNT[bits & ((1 << quarter) - 1)], -1)
            halves.append((child, np.where(held, highest - gaps[np.where(held, child, 0)].astype(np.int64), 0)))
        return halves


class Best:
    """An item's k highest documents so far, equal scores by id, a null id last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.nulls = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)

    def least(self) -> int:
        """The score from which on a document may be among the k highest."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        if len(scores):
            scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
            by = np.lexsort((ids, nulls, -scores))[:self.k]
            self.scores, self.ids, self.nulls = scores[by], ids[by], nulls[by]


def descend(treap: Treap, rows: np.ndarray, times: np.ndarray, best: Best, ids: np.ndarray, nulls: np.ndarray) -> None:
    """Offer ``best`` every document whose score can be among its k highest; ``ids`` and ``nulls`` are by column."""
    h = treap.height
    inside = rows >> h == 0  # terms of lower rows than any that the chunk has
    rows, times = rows[inside], times[inside]
    q = len(rows)
    if not q:
        return
    level, column = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    nodes = np.zeros((1, q), dtype=np.int64)
    highest = np.full((1, q), treap.highest, dtype=np.int64)
    bound = highest @ times
    while len(bound):
        alive = np.flatnonzero(bound >= best.least())
        if len(alive) * q > PATHS_HELD:
            take = alive[np.lexsort((-bound[alive], -level[alive]))[:OPEN_AT_ONCE]]
        elif len(alive) > OPEN_AT_ONCE:
            take = alive[np.argpartition(-bound[alive], OPEN_AT_ONCE)[:OPEN_AT_ONCE]]
        else:
            take = alive
        stay = np.setdiff1d(alive, take, assume_unique=True)
        kept = [(level[stay], column[stay], nodes[stay], highest[stay], bound[stay])]
        for at in np.unique(level[take]).tolist():
            now = take[level[take] == at]
            row_bits = ((rows >> (h - 1 - at)) & 1)[None, :]
            for bit, (child, tops) in enumerate(treap.children(at, nodes[now], highest[now], row_bits)):
                sums, place = tops @ times, 2 * column[now] + bit
                on = np.flatnonzero(sums >= best.least())
                if at + 1 == h:
                    best.offer(sums[on], ids[place[on]], nulls[place[on]])
                else:
                    kept.append((np.full(len(on), at + 1), place[on], child[on], tops[on], sums[on]))
        level, column, nodes, highest, bound = (np.concatenate(x) for x in zip(*kept))


class Chunk:
    """Postings of the documents of a task, up to the size of one treap."""

    def __init__(self):
        self.ids, self.lengths, self.parts = [], [], []
        self.cells = 0

    def add(self, doc_id, length: int, rows: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((np.full(len(rows), len(self.ids)), rows, counts))
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.cells += len(rows)

    def treap(self, weight: np.ndarray, documents: int, terms: int):
        """(treap, ids, whether an id is null) by column: columns follow the documents' lengths."""
        m = np.array([75 + 25 * n * documents // terms for n in self.lengths], dtype=np.int64)
        columns, rows, counts = (np.concatenate(x) for x in zip(*self.parts))
        impact = weight[rows] * (1_000_000_000 * counts // (1000 * counts + 12 * m[columns]))
        order = np.argsort(m, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        some = impact > 0
        nulls = np.array([i is None for i in self.ids], dtype=bool)[order]
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)[order]
        return (Treap(rows[some], place[columns[some]], impact[some]) if some.any() else None), ids, nulls


def _counts(shared):
    """Task sums: documents with a term (place -1), terms (-2), and documents a grid row."""
    def run(batches):
        rows = shared.value.rows
        df, documents, terms = np.zeros(len(rows), dtype=np.int64), 0, 0
        for b in batches:
            for text in b.column("text").to_pylist():
                found = terms_of(text)
                documents += bool(found)
                terms += len(found)
                df[[rows[t] for t in rows.keys() & set(found)]] += 1
        places = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *places.tolist()], pa.int64()), pa.array([documents, terms, *df[places].tolist()], pa.int64())],
            names=["place", "n"])

    return run


def _ranked(shared, documents: int, terms: int, k: int, documents_at_once: int, cells_at_once: int):
    def run(batches):
        items: Items = shared.value
        rows, best = items.rows, {}

        def search(chunk: Chunk) -> None:
            treap, ids, nulls = chunk.treap(items.weight, documents, terms)
            for number, own, times in items.queries if treap else ():
                descend(treap, own, times, best.setdefault(number, Best(k)), ids, nulls)

        chunk = Chunk()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = terms_of(text)
                counts = Counter(x for x in map(rows.get, found) if x is not None)
                if not counts:
                    continue
                chunk.add(doc_id, len(found), np.fromiter(counts.keys(), np.int64, len(counts)),
                          np.fromiter(counts.values(), np.int64, len(counts)))
                if len(chunk.ids) >= documents_at_once or chunk.cells >= cells_at_once:
                    search(chunk)
                    chunk = Chunk()
        if chunk.ids:
            search(chunk)
        for number, top in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(top.ids), pa.int64()), pa.array(top.ids, pa.int64(), mask=top.nulls),
                 pa.array(top.scores, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _highest(found: DataFrame, keys: list, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, id_col: str, text_col: str, items_at_once: int, chars_at_once: int):
    """The item rows on the driver, block by block, dealt by a hash, numbered over all blocks."""
    rows = text_docs(items, id_col=id_col, text_col=text_col)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, math.ceil(size["n"] / items_at_once), math.ceil((size["chars"] or 0) / chars_at_once))
    number = 0
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == block).collect()
        yield [(number + i, r["doc_id"], r["text"]) for i, r in enumerate(part)]
        number += len(part)


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", documents_at_once: int = 8192,
                  cells_at_once: int = 1 << 21, items_at_once: int = 2000, chars_at_once: int = 20_000_000,
                  fan_in: int = 64) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest documents.

    A treap holds ``documents_at_once`` documents, or fewer once they have
    ``cells_at_once`` cells.  Items go in blocks of about ``items_at_once`` rows and
    ``chars_at_once`` characters; the best of ``fan_in`` groups of tasks are found
    before those of all, so no task merges what every other one has found.
    """
    spark = docs.sparkSession
    kept = text_docs(docs, id_col=id_col, text_col=text_col)
    out = None
    for block in _blocks(items, item_id_col, item_text_col, items_at_once, chars_at_once):
        grid = Items([(number, text) for number, _, text in block])
        if not grid.items:
            continue
        counted = spark.sparkContext.broadcast(grid)
        sums = {r["place"]: r["n"] for r in kept.select("text").mapInArrow(_counts(counted), "place long, n long")
                .groupBy("place").agg(F.sum("n").alias("n")).collect()}
        counted.unpersist()
        documents, terms = sums.pop(-1, 0), sums.pop(-2, 0)
        if not terms:
            break
        grid.weigh(documents, sums)
        found = kept.mapInArrow(_ranked(spark.sparkContext.broadcast(grid), documents, terms, k, documents_at_once, cells_at_once), FOUND)
        found = found.withColumn("of", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
        top = _highest(_highest(found, ["item", "of"], k).select("item", "doc_id", "score"), ["item"], k)
        names = spark.createDataFrame([(number, item_id) for number, item_id, _ in block], "item long, item_id long")
        ranked = top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def oracle_sql(k: int = 20) -> str:
    """DuckDB SQL for ``ranked_search`` of ``benchmark`` over ``documents``, document by document."""
    def terms(table: str, key: str) -> str:
        lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {key}, unnest(regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table}"

    return f"""
WITH words AS MATERIALIZED ({terms('documents', 'doc_id')}),
asked AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM ({terms('benchmark', 'item_id')}) GROUP BY ALL),
lengths AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term),
impacts AS MATERIALIZED (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS impact
  FROM tf JOIN weights USING (term) JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= {k}"""
