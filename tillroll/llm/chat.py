"""Chat formatting with loss masks aligned to tokens by character offsets.

Turns are rendered by a template: marks around each turn's text, every control
string inside a text escaped, so that the text of a turn can hold no mark and can
be read back exactly.  A rendered piece is encoded once, with character offsets.
The spans of the turns that are learned are sorted, as token spans are, so each
token finds its span by binary search; the loss mask holds the tokens that meet
such a span.  Marks are added tokens of the encoder, so no token reaches over a
turn's border.

Turns are sorted by conversation and turn over all tasks, and a task reads its
range as a stream.  A conversation is one piece unless it is longer than
``piece_chars`` or lies on the border of two ranges; its further pieces follow
on, so no conversation is ever held whole, whatever share of the rows it has.

Defined results: a null text or role is empty; turns follow their number, nulls
first, ties by role, then by a hash of the text, then by the text; repeated rows
are turns each; all rows of a null conversation id are one conversation; any
string can be a role; a conversation without a learned turn has an empty loss
text; an empty table gives no rows; texts are never shortened.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_OUT = 64
BYTES_AT_ONCE = 8 << 20
PIECES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("text", pa.string()),
    ("ids", pa.list_(pa.int32())), ("token_start", pa.list_(pa.int32())), ("token_end", pa.list_(pa.int32())),
    ("loss", pa.list_(pa.bool_())), ("n_turns", pa.int64())])
PIECES_DDL = ("conv_id long, part long, piece long, whole boolean, text string, ids array<int>, "
              "token_start array<int>, token_end array<int>, loss array<boolean>, n_turns long")


@dataclass(frozen=True)
class Template:
    """Marks before and after the text of each role (one role may have none before).

    ``other`` has the marks before the name of any other role, before its text, and after it.
    """

    roles: tuple = (("user", "[INST]", "[/INST]"), ("system", "[SYS]", "[/SYS]"), ("assistant", "", "</s>"))
    other: tuple = ("[ROLE]", "[TEXT]", "[/ROLE]")
    controls: tuple = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "<|endoftext|>")
    learned: tuple = ("assistant",)

    def __post_init__(self):
        marks = [m for _, *ms in self.roles for m in ms if m] + list(self.other)
        if not set(marks) <= set(self.controls) or any(not after for _, _, after in self.roles):
            raise ValueError("every mark must be a control string, and every turn must end with one")
        # Escaping tells occurrences apart by their first character alone.
        first = {c[0] for c in self.controls}
        if any(len(c) < 2 or first & set(c[1:]) or c[1] == "\\" for c in self.controls) or "\\" in first:
            raise ValueError("control strings must hold their first characters nowhere else")

    @cached_property
    def marks(self) -> dict:
        return {role: (before, after) for role, before, after in self.roles}

    @cached_property
    def _inside(self) -> re.Pattern:
        """A control string, or one with backslashes after its first character."""
        heads = {}
        for c in sorted(self.controls, key=len, reverse=True):
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        return re.compile("|".join(rf"(?<={re.escape(h)})(\\*)(?={'|'.join(rests)})" for h, rests in heads.items()))

    def escape(self, text: str) -> str:
        """``text`` with one more backslash after the first character of every (escaped) control string."""
        return self._inside.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._inside.sub(lambda m: m[0][1:], text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """(the rendered turn, where its text begins, where it ends)."""
        body = self.escape(text)
        if role in self.marks:
            before, after = self.marks[role]
        else:
            open_, middle, after = self.other
            before = open_ + self.escape(role) + middle
        return before + body + after, len(before), len(before) + len(body)

    def read(self, formatted: str):
        """Yield (role, text, first, end) of every turn of a formatted piece; ``first`` and ``end`` border the escaped text."""
        at = 0
        silent = next((role for role, before, _ in self.roles if not before), None)
        while at < len(formatted):
            role = next((r for r, before, _ in self.roles if before and formatted.startswith(before, at)), None)
            if role is not None:
                before, after = self.marks[role]
                first = at + len(before)
            elif formatted.startswith(self.other[0], at):
                named = at + len(self.other[0])
                middle = formatted.index(self.other[1], named)
                role, first, after = self.unescape(formatted[named:middle]), middle + len(self.other[1]), self.other[2]
            else:
                role, first, after = silent, at, self.marks[silent][1]
            end = formatted.index(after, first)
            yield role, self.unescape(formatted[first:end]), first, end
            at = end + len(after)


class Encoder:
    """Ids and character offsets, with the template's control strings as added tokens."""

    def __init__(self, vocabulary: str, template: Template):
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        known = self.tokenizer.get_vocab()
        self.tokenizer.add_special_tokens([AddedToken(c, normalized=False) for c in template.controls if c not in known])

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first characters, ends) of the tokens; tokens of one character share its span."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, dtype=np.int32).reshape(-1, 2)
        return np.array(found.ids, dtype=np.int32), spans[:, 0], spans[:, 1]


@lru_cache(maxsize=2)
def encoder(vocabulary: str, template: Template) -> Encoder:
    """One encoder a worker process, not one a task."""
    return Encoder(vocabulary, template)


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet a span; spans are sorted and apart, tokens are sorted."""
    if not spans:
        return np.zeros(len(starts), dtype=bool)
    first, last = np.array(spans, dtype=np.int64).T
    at = np.searchsorted(first, ends, side="left") - 1  # the last span that begins before the token ends
    return (at >= 0) & (last[np.maximum(at, 0)] > starts) & (ends > starts)


def masked_spans(starts, ends, loss) -> list[tuple[int, int]]:
    """Character spans under the mask, those that touch joined."""
    out: list[tuple[int, int]] = []
    for s, e in zip(np.asarray(starts)[loss].tolist(), np.asarray(ends)[loss].tolist()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The turns in order, over all tasks; the last key deals equal rows apart and changes no result."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "h")]
    spread = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    return spread.repartitionByRange(*keys, F.col("row")).sortWithinPartitions(*keys, "text").select(
        "conv_id", "role", "text")


class Piece:
    """A run of turns of one conversation, on its way to one row."""

    def __init__(self, conv_id, number: int, template: Template):
        self.conv_id, self.number, self.template = conv_id, number, template
        self.parts, self.spans, self.size, self.turns = [], [], 0, 0

    def add(self, role: str, text: str) -> None:
        rendered, first, end = self.template.turn(role, text)
        if role in self.template.learned and end > first:
            self.spans.append((self.size + first, self.size + end))
        self.parts.append(rendered)
        self.size += len(rendered)
        self.turns += 1

    def row(self, encode: Encoder, part: int, whole: bool) -> tuple:
        text = "".join(self.parts)
        ids, starts, ends = encode(text)
        return (self.conv_id, part, self.number, whole, text, ids, starts, ends, loss_mask(starts, ends, self.spans), self.turns)


def _pieces(rows, template: Template, encode, part: int, piece_chars: int):
    """Rows of ``PIECES`` from a sorted stream of (conv_id, role, text).

    The first and the last conversation of a range may go on in another one, so they are not marked whole."""
    piece, first = None, True
    for conv_id, role, text in rows:
        if piece is None:
            piece = Piece(conv_id, 0, template)
        elif conv_id != piece.conv_id:
            yield piece.row(encode, part, piece.number == 0 and not first)
            piece, first = Piece(conv_id, 0, template), False
        elif piece.size >= piece_chars:
            yield piece.row(encode, part, False)
            piece = Piece(conv_id, piece.number + 1, template)
        piece.add(role, text)
    if piece is not None:
        yield piece.row(encode, part, False)


def format_chats(conversations: DataFrame, vocabulary: str, *, template: Template = Template(), piece_chars: int = 1 << 18,
                 conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formatted pieces: conv_id, part, piece, whole, text, ids, token_start, token_end, loss, n_turns.

    A conversation's pieces are in order by (part, piece); ``whole`` marks those
    that surely are all of their conversation.  ``loss`` has one flag a token.
    """
    def run(batches):
        encode, part = encoder(vocabulary, template), TaskContext.get().partitionId()
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(3))))
        held, size = [], 0
        for row in _pieces(rows, template, encode, part, piece_chars):
            held.append(row)
            size += len(row[4])
            if len(held) >= ROWS_OUT or size >= piece_chars:
                yield _batch(held)
                held, size = [], 0
        yield _batch(held)

    _bounded_batches(conversations)
    return _turns(conversations, conv_col, turn_col, role_col, text_col).mapInArrow(run, PIECES_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(PIECES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def _bounded_batches(df: DataFrame) -> None:
    """Bound the bytes of an Arrow batch, for rows that hold whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_AT_ONCE))


DIGESTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()),
                     ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                     ("formatted_chars", pa.int64()), ("turns", pa.binary()), ("learned", pa.binary())])
DIGESTS_DDL = ("conv_id long, part long, piece long, n_turns long, turns_sha256 string, loss_chars long, "
               "loss_sha256 string, formatted_chars long, turns binary, learned binary")
RESULT = [f.name for f in DIGESTS if f.name not in ("part", "piece", "turns", "learned")]


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def digests(pieces: DataFrame, *, template: Template = Template()) -> DataFrame:
    """One row a conversation, read back from its formatted pieces.

    Returns conv_id, n_turns, turns_sha256 (of role, newline, text, newline a
    turn), loss_chars and loss_sha256 (of the unescaped text under the loss mask)
    and formatted_chars.  A whole conversation's digests are made where its piece
    is; pieces of the others bring their bytes to one stream a conversation,
    which is hashed as it is read, since SHA-256 takes its input in order.
    """
    def read(row: dict) -> tuple:
        text = row["text"]
        turns = b"".join(_utf8(f"{role}\n{body}\n") for role, body, _, _ in template.read(text))
        learned = "".join(template.unescape(text[s:e])
                          for s, e in masked_spans(row["token_start"], row["token_end"], np.array(row["loss"], dtype=bool)))
        whole = row["whole"]
        sha = [hashlib.sha256(x).hexdigest() if whole else None for x in (turns, _utf8(learned))]
        return (row["conv_id"], row["part"], row["piece"], row["n_turns"], sha[0], len(learned), sha[1], len(text),
                None if whole else turns, None if whole else _utf8(learned))

    def per_piece(batches):
        for b in batches:
            rows = [read(r) for r in b.to_pylist()]
            columns = list(zip(*rows)) or [[]] * len(DIGESTS)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, DIGESTS)], schema=DIGESTS)

    def per_conversation(batches):
        out_schema = pa.schema([DIGESTS.field(n) for n in RESULT])
        open_ = None  # (conv_id, turns, hash of turns, loss characters, hash of loss, formatted characters)

        def settled(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [[]] * len(out_schema), out_schema)], schema=out_schema)

        def closed(o):
            return (o[0], o[1], o[2].hexdigest(), o[3], o[4].hexdigest(), o[5])

        for b in batches:
            rows = []
            for r in b.to_pylist():
                if open_ is not None and (r["turns"] is None or r["conv_id"] != open_[0]):
                    rows.append(closed(open_))
                    open_ = None
                if r["turns"] is None:
                    rows.append(tuple(r[n] for n in RESULT))
                    continue
                if open_ is None:
                    open_ = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                open_[1] += r["n_turns"]
                open_[2].update(r["turns"])
                open_[3] += r["loss_chars"]
                open_[4].update(r["learned"])
                open_[5] += r["formatted_chars"]
            yield settled(rows)
        if open_ is not None:
            yield settled([closed(open_)])

    _bounded_batches(pieces)
    return (pieces.select("conv_id", "part", "piece", "whole", "text", "token_start", "token_end", "loss", "n_turns")
            .mapInArrow(per_piece, DIGESTS_DDL).repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
            .mapInArrow(per_conversation, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                          "loss_sha256 string, formatted_chars long"))


def oracle_sql(extra: str, template: Template = Template()) -> str:
    """DuckDB SQL for the digests of ``conversations`` and the turns ``extra`` (VALUES of conv_id, turn, role, text)."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    heads = {}
    for c in template.controls:
        heads.setdefault(c[0], []).append(re.escape(c[1:]))
    escaped = "text"
    for h, rests in heads.items():
        escaped = rf"regexp_replace({escaped}, {quoted(rf'({re.escape(h)}\\*)({'|'.join(rests)})')}, '\1\\\2', 'g')"
    named = escaped.replace("(text,", "(role,", 1)
    marks = " ".join(f"WHEN role = {quoted(r)} THEN {len(a) + len(b)}" for r, a, b in template.roles)
    learned = ", ".join(map(quoted, template.learned))
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {extra}) AS extra(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role IN ({learned})), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role IN ({learned})), '')) AS loss_sha256,
       CAST(sum(length({escaped}) + CASE {marks} ELSE length({named}) + {sum(map(len, template.other))} END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
