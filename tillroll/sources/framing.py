"""Framing of large landed files: record borders by prefix sums of bracket depth.

A file that is one JSON value over many lines may be larger than a task's
memory, so its lines are never brought together.  They are cut into blocks, and
each block is summed up by itself: how far the bracket depth rises, and how many
commas and characters lie at each depth.  (No JSON string reaches over a line,
so a block needs nothing from the one before.)  Sums over the blocks before give
each block its depth and the numbers of the first member and element in it.  Then
every block deals its text out: the elements of the root's members by (member,
element), and all that lies outside of them, the skeleton, such as
``{"users": [], "total": 9}``.  Parts of one element meet again by their numbers; no group is
larger than one record.  The skeleton tells which member holds the records.

A file whose skeleton is no JSON value, or is too long, has text that no reader
could take as records: all its parts are handed on as faults, none is dropped.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
SKELETON_BYTES = 1 << 20
DEEPEST = 1000  # the nesting at which JSON parsers give up
SKELETON, FAULT = -1, -2  # members that are none

BLOCKS = pa.schema([
    ("_source", pa.string()), ("_landed", pa.timestamp("us", tz="UTC")), ("_block", pa.int64()), ("_cut", pa.int64()),
    ("text", pa.binary()), ("rise", pa.int64()), ("first", pa.string()), ("broken", pa.bool_()),
    ("depths", pa.list_(pa.int32())), ("commas", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64()))])
BLOCKS_DDL = ("_source string, _landed timestamp, _block long, _cut long, text binary, rise long, first string, "
              "broken boolean, depths array<int>, commas array<bigint>, chars array<bigint>")
PARTS = pa.schema([("_source", pa.string()), ("_landed", pa.timestamp("us", tz="UTC")), ("_block", pa.int64()), ("_cut", pa.int64()),
                   ("member", pa.int64()), ("element", pa.int64()), ("text", pa.binary())])
PARTS_DDL = "_source string, _landed timestamp, _block long, _cut long, member long, element long, text binary"


class Structure:
    """Bracket depth and separators of a block that begins at depth 0, outside of strings."""

    def __init__(self, text: bytes):
        # An escaped quote ends no string; pairs of backslashes escape nothing.
        plain = np.frombuffer(text.replace(b"\\\\", b"__").replace(b'\\"', b"__"), dtype=np.uint8)
        quotes = plain == ord('"')
        inside = (np.cumsum(quotes) & 1).astype(bool)
        self.broken = bool(inside[plain == ord("\n")].any()) or bool(len(inside) and inside[-1])
        free = ~inside & ~quotes
        step = np.zeros(len(plain), dtype=np.int32)
        step[free & ((plain == ord("[")) | (plain == ord("{")))] = 1
        step[free & ((plain == ord("]")) | (plain == ord("}")))] = -1
        self.depth = np.cumsum(step)  # after each byte
        self.least = np.minimum(self.depth, self.depth - step)  # brackets belong to what lies around them
        self.commas = free & (plain == ord(","))
        self.rise = int(self.depth[-1]) if len(plain) else 0
        self.blank = np.isin(plain, np.frombuffer(b" \t\r\n", dtype=np.uint8)) & ~inside

    def at_depths(self) -> tuple[list[int], list[int], list[int]]:
        """(depths, commas at each, other bytes that are not blank at each)."""
        low = int(self.least.min()) if len(self.least) else 0
        commas = np.bincount(self.least[self.commas] - low) if self.commas.any() else np.zeros(1, dtype=np.int64)
        chars = np.bincount(self.least[~self.blank] - low) if not self.blank.all() else np.zeros(1, dtype=np.int64)
        count = Counter({low + i: int(c) for i, c in enumerate(commas) if c})
        size = {low + i: int(c) for i, c in enumerate(chars) if c}
        depths = sorted({*count, *size})
        return depths, [count[d] for d in depths], [size.get(d, 0) for d in depths]


def blocks_of(lines: DataFrame, block_bytes: int) -> DataFrame:
    """The lines of each split, in order, as blocks of about ``block_bytes``, with their sums."""
    def run(batches):
        key, held, size, cut = None, [], 0, 0

        def block():
            text = b"\n".join(held)
            s = Structure(text)
            depths, commas, chars = s.at_depths()
            broken = s.broken or bool(len(depths) and max(map(abs, depths)) > DEEPEST)
            head = text.lstrip()[:1].decode("utf-8", "replace")
            row = (key[0], key[1], key[2], cut, text, s.rise, head, broken,
                   *(([], [], []) if broken else (depths, commas, chars)))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)

        for b in batches:
            columns = [b.column(n).to_pylist() for n in ("_source", "_landed", "_block", "value")]
            for source, landed, start, value in zip(*columns):
                if key != (source, landed, start) or size >= block_bytes:
                    if held:
                        yield block()
                    cut = cut + 1 if key == (source, landed, start) else 0
                    key, held, size = (source, landed, start), [], 0
                held.append(value.encode("utf-8", "surrogatepass"))
                size += len(held[-1]) + 1
        if held:
            yield block()

    return lines.select("_source", "_landed", "_block", "value").mapInArrow(run, BLOCKS_DDL)


def _placed(blocks: DataFrame, skeleton_bytes: int) -> DataFrame:
    """Blocks with what the blocks before them sum up to: depth, member and element, and whether the file is a fault."""
    marks = blocks.drop("text", "_landed")
    whole = Window.partitionBy("_source")
    order = whole.orderBy("_block", "_cut")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def at(depth: int, values: str):
        """Sum of a block's values at one depth of the file."""
        return F.aggregate(F.arrays_zip("depths", values), F.lit(0).cast("bigint"), lambda a, x: a + F.when(
            x["depths"] + F.col("depth") == depth, x[values]).otherwise(F.lit(0).cast("bigint")))

    marks = (marks.withColumn("root", F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
             # Elements of a bare list lie as deep as those of an envelope's list.
             .withColumn("depth", F.coalesce(F.sum("rise").over(before), F.lit(0)) + F.when(F.col("root") == "[", 1).otherwise(0)))
    outer = at(0, "chars") + at(1, "chars")
    marks = (marks.withColumn("member", F.coalesce(F.sum(at(1, "commas")).over(before), F.lit(0)))
             .withColumn("element", F.coalesce(F.sum(at(2, "commas")).over(before), F.lit(0)))
             .withColumn("fault", F.max(F.col("broken")).over(whole) | ~F.col("root").isin("[", "{")
                         | (F.sum(outer).over(whole) > skeleton_bytes)))
    return blocks.select("_source", "_landed", "_block", "_cut", "text").join(
        marks.select("_source", "_block", "_cut", "depth", "member", "element", "fault"), ["_source", "_block", "_cut"])


def deal(text: bytes, depth: int, member: int, element: int):
    """Yield (member, element, text) of a block that begins at ``depth``, ``member`` and ``element``."""
    s = Structure(text)
    least = s.least + depth
    outer = least <= 1
    data = np.frombuffer(text, dtype=np.uint8)
    cuts = np.flatnonzero(s.commas & ((least == 1) | (least == 2)))
    start = 0
    for end in [*cuts.tolist(), len(data)]:
        part = data[start:end]
        inner = part[~outer[start:end]].tobytes()
        if inner.strip():
            yield member, element, inner
        if end < len(data):
            if least[end] == 1:
                member += 1
            else:
                element += 1
        start = end + 1
    kept = data[outer].tobytes()
    if kept.strip():
        yield SKELETON, 0, kept


def _parts(placed: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                if r["fault"]:
                    found = [(FAULT, 0, r["text"])]
                else:
                    found = list(deal(r["text"], r["depth"], r["member"], r["element"]))
                where = (r["_source"], r["_landed"], r["_block"], r["_cut"])
                columns = list(zip(*[(*where, *f) for f in found])) or [[]] * len(PARTS)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, PARTS)], schema=PARTS)

    return placed.mapInArrow(run, PARTS_DDL)


def _joined(parts: DataFrame, *keys: str) -> DataFrame:
    """The parts of one element (or skeleton), in the order of the file."""
    at = F.struct("_block", "_cut", "text")
    return parts.groupBy("_source", "_landed", *keys).agg(F.sort_array(F.collect_list(at)).alias("_at")).select(
        "_source", "_landed", *keys, F.decode(F.aggregate(
            "_at", F.lit(b""), lambda a, x: F.concat(a, x["text"])), "UTF-8").alias("text"))


def framed_values(lines: DataFrame, key: str, *, block_bytes: int = BLOCK_BYTES, skeleton_bytes: int = SKELETON_BYTES) -> DataFrame:
    """One row per record of large files, each in an envelope of its own: ``_source, _landed, text, _fault``.

    ``lines`` has ``_source, _landed, _block, value``: the lines of each split in
    order.  Rows with ``_fault`` have text that is no record of any kind.
    """
    parts = _parts(_placed(blocks_of(lines, block_bytes), skeleton_bytes))
    elements = _joined(parts.where(F.col("member") >= 0), "member", "element").alias("e")
    skeletons = _joined(parts.where(F.col("member") == SKELETON)).select("_source", "_landed", F.trim("text").alias("skeleton"))
    # What follows a value is no part of it: the number behind it shows that it ended where the text does.
    end = F.xxhash64("skeleton")
    parsed = F.from_json(F.concat(F.lit('{"_":['), F.col("skeleton"), F.lit('],"end":'), end.cast("string"), F.lit("}")),
                         f"struct<_: array<struct<`{key}`: string, total: string>>, end: bigint>")
    one = (F.col("p.end") == end) & (F.size("p._") == 1)
    listed = F.col("skeleton").rlike(r"^\[\s*\]$")
    skeletons = skeletons.withColumn("p", F.when(F.col("skeleton").startswith("{"), parsed)).select(
        "_source", "_landed", "skeleton", F.col("p._")[0]["total"].alias("total"),
        F.coalesce(listed | (one & ~F.coalesce(F.col("p._")[0][key].startswith("{"), F.lit(False))), F.lit(False)).alias("sound"),
        F.when(listed, 0).otherwise(F.array_position(F.json_object_keys("skeleton"), key) - 1).alias("of")).alias("s")
    both = elements.join(skeletons, (F.col("e._source") == F.col("s._source")) & F.col("e._landed").eqNullSafe(F.col("s._landed")), "left")
    sound = F.coalesce(F.col("sound"), F.lit(False))
    total = F.coalesce(F.concat(F.lit(',"total":'), F.col("total").try_cast("bigint").cast("string")), F.lit(""))
    envelope = F.concat(F.lit(f'{{"{key}":['), F.col("text"), F.lit("]"), total, F.lit("}"))
    records = both.where(~sound | (F.col("member") == F.col("of"))).select(
        F.col("e._source").alias("_source"), F.col("e._landed").alias("_landed"),
        F.when(sound, envelope).otherwise(F.col("text")).alias("text"), (~sound).alias("_fault"))
    faults = parts.where(F.col("member") == FAULT).select(
        "_source", "_landed", F.decode("text", "UTF-8").alias("text"), F.lit(True).alias("_fault"))
    broken = skeletons.where("NOT sound").select("_source", "_landed", F.col("skeleton").alias("text"), F.lit(True).alias("_fault"))
    return records.unionByName(faults).unionByName(broken)
