from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm.packing import Encoder, merge_leftovers, pack_documents, pack_partition
from tillroll.llm.queries import op1_packing, pack

PLAIN = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
FAST = Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab 'sS1.,\n\t\r\x0b\x1c\x85\xa0éßÅ…’— $", max_size=60))
def test_fast_ids_equal_the_library(text):
    assert FAST(text) == ids_of(text)


def check_pieces(rows, texts, window=1024):
    """Each document's ids lie once in its pieces; sequences are gapless and within the window."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    wanted = defaultdict(list)
    for doc_id, text in texts:
        wanted[doc_id].append([*ids_of(text), 0])
    assert set(pieces) == set(wanted)
    for doc_id, found in pieces.items():
        starts = defaultdict(list)
        for r in found:
            starts[r["start"]].append(r)
        for ids in wanted[doc_id]:
            at = 0
            while at < len(ids):
                fits = [r for r in starts[at] if r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc32(
                    np.array(ids[at:at + r["length"]], dtype="<u4").tobytes())]
                assert fits, (doc_id, at)
                starts[at].remove(fits[0])
                at += fits[0]["length"]
        assert not any(starts.values())
    padding = total = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(total, 1)


def test_pieces_of_the_sample(spark, sample_docs):
    rows = op1_packing(spark, "/root/testdata/sf0.001").collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in sample_docs.collect()])


def test_padding_is_small_at_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    share = check_pieces(pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert share < 0.02


def test_edge_rows(edge_docs, no_docs):
    rows = pack(edge_docs).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert [r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert pack(no_docs).count() == 0


def test_ids_are_kept_on_request(edge_docs):
    rows = pack_documents(edge_docs, P.path("byte_bpe_50k.json"), with_ids=True).collect()
    assert all(crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 5))
def test_online_packing_keeps_few_windows_open(sizes, open_windows):
    docs = [(i, "x" * n) for i, n in enumerate(sizes)]
    rows = list(pack_partition(iter(docs), lambda t: [7] * len(t), 3, window=16, open_windows=open_windows,
                               separator=0, fan_in=2, with_ids=False))
    left = [r for r in rows if r[7] >= 0]
    assert len({r[5] for r in left}) <= open_windows and {r[7] for r in left} <= {1}
    merged = list(merge_leftovers(((r[0], r[1], r[4], r[8]) for r in sorted(left, key=lambda r: (r[5], r[6]))), 1, window=16))
    fills = defaultdict(int)
    for r in merged:
        fills[r[5]] += r[2]
    assert sum(f < 16 for f in fills.values()) <= 1
    assert sum(r[2] for r in rows if r[7] < 0) + sum(fills.values()) == sum(n + 1 for n in sizes)


def test_added_tokens_have_their_own_ids(spark):
    untouched = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|>" * 3, "x<|endoftext|>你", "<|endoftext|", "a < b | c", "你"]
    want = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert [FAST(t) for t in texts] == want and want[0] == [64, 50256, 65]
    rows = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["doc_tokens"], r["ids_crc32"]) for r in rows} == {
        (i, len(ids) + 1, crc32(np.array([*ids, 0], dtype="<u4").tobytes())) for i, ids in enumerate(want)}
