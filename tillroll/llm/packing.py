"""Sequence packing: bounded-space online best fit over tokenised documents.

Each partition streams its documents.  A document's ids (then the separator) are
cut into whole windows; the rest is placed into the open window it fits best.
At most ``open_windows`` windows are open at once: when none fits, the fullest
is emitted and a new one opened.  What is still open at the end of a partition
is merged with the leftovers of ``fan_in`` - 1 other partitions, where pieces
may be cut once more, so each merged group has one window that is not full.

Defined results: a null or empty text is one piece that holds the separator
alone; repeated rows are packed once each; an empty table gives no rows; a null
id is carried through.  Texts are never shortened.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpointed, text_docs

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, merge_group long, ids array<int>")
ROWS_OUT = 4096
# One letter repertoire for which both tokenizer libraries split words alike.
OTHER_LETTERS = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")


class Encoder:
    """Byte-level BPE ids of a text, as the ``tokenizers`` library gives them.

    The ranks of the same vocabulary run several times faster in ``tiktoken``;
    its ids are identical for Latin texts (tests compare the two), and any text
    with another letter or an added token of the vocabulary goes to
    ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        self.vocabulary, self.fast, self._slow = vocabulary, None, None
        if ranks:
            import base64
            import json

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            with open(vocabulary, encoding="utf-8") as f:
                self.added = [a["content"] for a in json.load(f).get("added_tokens") or ()]

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.vocabulary)
        return self._slow

    def __call__(self, text: str) -> list[int]:
        if self.fast and not OTHER_LETTERS.search(text) and not any(a in text for a in self.added):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str | None, pattern: str | None) -> Encoder:
    """One encoder a worker process, not one a task."""
    return Encoder(vocabulary, ranks, pattern)


class Rows:
    """Piece rows on their way into an Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns = schema, [[] for _ in schema]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row):
            column.append(value)

    def __len__(self) -> int:
        return len(self.columns[0])

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
        self.columns = [[] for _ in self.schema]
        return out


def arrow_schema() -> pa.Schema:
    longs = [(n.split()[0], pa.int64()) for n in PIECES.split(", ")[:-1]]
    return pa.schema([*longs, ("ids", pa.list_(pa.int32()))])


def _crc(ids: np.ndarray) -> int:
    return crc32(ids.astype("<u4", copy=False).tobytes())


def pack_partition(documents, encode, partition: int, *, window: int, open_windows: int,
                   separator: int, fan_in: int, with_ids: bool):
    """Yield piece rows of one partition.  ``documents`` yields (doc_id, text)."""
    base, emitted = partition << 33, 0
    open_pieces: dict[int, list] = {}  # window number -> [(doc_id, start, doc_tokens, ids)]
    fills: list[tuple[int, int]] = []  # (fill, window number), ascending
    opened = 0

    def emit(pieces, group=-1):
        nonlocal emitted
        offset = 0
        for doc_id, start, total, ids in pieces:
            kept = ids if with_ids or group >= 0 else None
            yield (doc_id, start, len(ids), _crc(ids), total, base + emitted, offset, group, kept)
            offset += len(ids)
        emitted += 1

    for doc_id, text in documents:
        ids = np.array([*encode(text), separator], dtype=np.int32)
        total, start = len(ids), 0
        while total - start >= window:
            yield from emit([(doc_id, start, total, ids[start:start + window])])
            start += window
        rest = total - start
        if not rest:
            continue
        piece = (doc_id, start, total, ids[start:])
        # The fullest window that still has room: best fit.
        at = bisect_left(fills, (window - rest + 1, -1)) - 1
        if at >= 0:
            fill, number = fills.pop(at)
        else:
            if len(fills) >= open_windows:
                _, fullest = fills.pop()
                yield from emit(open_pieces.pop(fullest))
            fill, number = 0, opened
            opened += 1
            open_pieces[number] = []
        open_pieces[number].append(piece)
        if fill + rest == window:
            yield from emit(open_pieces.pop(number))
        else:
            insort(fills, (fill + rest, number))
    for _, number in reversed(fills):
        yield from emit(open_pieces.pop(number), partition // fan_in)


def merge_leftovers(pieces, group: int, *, window: int):
    """Yield rows of full windows, but for the last, from a group's open windows.

    ``pieces`` yields (doc_id, start, doc_tokens, ids) in window order.
    """
    sequence, offset = (1 << 62) + (group << 33), 0
    for doc_id, start, total, ids in pieces:
        at = 0
        while at < len(ids):
            part = ids[at:at + window - offset]
            yield (doc_id, start + at, len(part), _crc(part), total, sequence, offset, -1, part)
            at += len(part)
            offset += len(part)
            if offset == window:
                sequence, offset = sequence + 1, 0


def pack_documents(docs: DataFrame, vocabulary: str, *, ranks: str | None = None, pattern: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text", window: int = 1024, open_windows: int = 64,
                   separator: int = 0, fan_in: int = 8, with_ids: bool = False) -> DataFrame:
    """Pack every document into sequences of at most ``window`` tokens.

    Returns one row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``with_ids``, the ids themselves.  Sequence
    ids are unique, not consecutive.  The pieces are written once to the
    checkpoint folder, since emitted and left-over windows are read apart.
    """
    schema = arrow_schema()

    def pack(batches):
        from pyspark import TaskContext

        encode = encoder(vocabulary, ranks, pattern)
        documents = ((d, t) for b in batches
                     for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()))
        rows = Rows(schema)
        for row in pack_partition(documents, encode, TaskContext.get().partitionId(), window=window,
                                  open_windows=open_windows, separator=separator, fan_in=fan_in, with_ids=with_ids):
            rows.add(*row)
            if len(rows) >= ROWS_OUT:
                yield rows.batch()
        yield rows.batch()

    def merge(key, held):
        held = held.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        columns = [held.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens")]
        ids = (np.asarray(x, dtype=np.int32) for x in held.column("ids").to_pylist())
        rows = Rows(schema)
        for row in merge_leftovers(zip(*columns, ids), key[0].as_py(), window=window):
            rows.add(*row[:-1], row[-1] if with_ids else None)
        return pa.Table.from_batches([rows.batch()])

    pieces = checkpointed(text_docs(docs, id_col=id_col, text_col=text_col).mapInArrow(pack, PIECES))
    merged = pieces.where("merge_group >= 0").groupBy("merge_group").applyInArrow(merge, PIECES)
    out = pieces.where("merge_group < 0").unionByName(merged).drop("merge_group")
    return out if with_ids else out.drop("ids")
