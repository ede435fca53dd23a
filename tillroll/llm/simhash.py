"""SimHash fingerprints and near-duplicate components by multi-index hashing.

A fingerprint takes the majority of each bit over the 64-bit hashes of a text's
word shingles.  Two fingerprints at most ``radius`` bits apart agree, in one of
``segments`` bit segments, up to radius // segments bits.  So each distinct
fingerprint enumerates the small Hamming balls of its segment values, probes the
table of segment values with them, and every match is verified on all 64 bits.
Links join the classes of equal fingerprints; components follow from the links.

Defined results: a null or empty text has fingerprint zero, linked like any
other; repeated rows share a fingerprint, so a component; a null id gets a
fingerprint and no component; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpointed, connected_components, text_docs

HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text: bit set where over half of the shingle hashes have it."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII only: A-Z, and its six white spaces
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    votes = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, HASHES_AT_ONCE):
        hi = min(n, lo + HASHES_AT_ONCE)
        hashes = np.array(
            [xxh64_intdigest(joined[a:b - 1], seed)
             for a, b in zip(starts[lo:hi], ends[lo + shingle - 1:hi + shingle - 1])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the signed 64-bit form of each document's fingerprint."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found.view(np.int64))], schema=schema)

    return text_docs(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id long, fp long")


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of a 64-bit fingerprint."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def near_pairs(classes: DataFrame, *, radius: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b) of class ids whose fingerprints differ in 1 to ``radius`` bits.

    ``classes`` has (rep, fp), one row a distinct fingerprint.  A ball is walked
    on one side only: of two values that differ, only the one with the smaller
    segment value flips bits, so each flip set starts at a bit that is 0 there.
    """
    if segments < 2:
        raise ValueError("a segment must be shorter than a fingerprint")

    def value(start, width):
        return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1))

    def entry(s, key):
        return F.struct(F.lit(s).alias("seg"), key.alias("key"))

    def ball(s, seg, width, reach):
        flips = [sum(1 << b for b in c) for r in range(1, reach + 1) for c in combinations(range(width), r)]
        masks = F.array(*[F.lit(m).cast("long") for m in flips])
        return F.transform(F.filter(masks, lambda m: seg.bitwiseXOR(m) > seg), lambda m: entry(s, seg.bitwiseXOR(m)))

    table, probes = [], []
    for s, (start, width) in enumerate(segment_bounds(segments)):
        seg = value(start, width)
        table.append(entry(s, seg))
        probes.append(F.array(entry(s, seg)))
        if radius >= segments:
            probes.append(ball(s, seg, width, radius // segments))
    entries = classes.select("rep", "fp", F.explode(F.array(*table)).alias("t")).select(
        F.col("t.seg").alias("seg"), F.col("t.key").alias("key"), F.col("rep").alias("b"), F.col("fp").alias("fb"))
    balls = classes.select("rep", "fp", F.explode(F.concat(*probes)).alias("t")).select(
        F.col("t.seg").alias("seg"), F.col("t.key").alias("key"), F.col("rep").alias("a"), F.col("fp").alias("fa"))
    return (balls.join(entries, ["seg", "key"])
            .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, segments: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits, the row's own included.
    """
    found = checkpointed(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed))
    classes = checkpointed(found.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    linked = connected_components(near_pairs(classes, radius=radius, segments=segments))
    named = checkpointed(
        classes.join(linked, F.col("rep") == F.col("node"), "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return found.join(named, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_per_component(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                      radius: int = 3, segments: int = 2) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of its component.

    Of rows that repeat an id, the smallest row stays; rows without an id stay.
    """
    found = checkpointed(
        near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, radius=radius, segments=segments)
        .where("doc_id IS NOT NULL").select("doc_id", "component_id"))
    names = docs.columns

    def joined(left, ids, how):
        return left.join(ids, left[id_col].cast("long") == ids["_component_doc_id"], how)

    leave = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_component_doc_id")).distinct()
    out = joined(docs, leave, "left_anti")
    again = (found.groupBy(F.col("doc_id").alias("_component_doc_id")).agg(F.count("*").alias("n"))
             .where("n > 1").select("_component_doc_id"))
    if again.isEmpty():
        return out
    first = (joined(out, again, "left_semi").groupBy(F.col(id_col).alias("_component_doc_id"))
             .agg(F.min(F.struct(*names)).alias("row")).select("row.*"))
    return joined(out, again, "left_anti").unionByName(first)
