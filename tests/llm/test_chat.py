import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm.chat import Template, digests, encoder, format_chats, loss_mask, masked_spans
from tillroll.llm.queries import _vocabulary

TEMPLATE = Template()
SCHEMA = "conv_id long, turn long, role string, text string, part int"
BITS = ["<", "[", "\\", "/", "s>", "INST]", "SYS]", "ROLE]", "TEXT]", "|endoftext|>", " ", "é", "x", "\n", *TEMPLATE.controls]
texts = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


def want(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        shown = "".join(TEMPLATE.turn(r, t)[0] for r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(), len(shown)))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = digests(format_chats(df, _vocabulary("byte_bpe_50k.json"), **how))
    assert out.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "[ROLE]"]) | texts, texts), max_size=5))
def test_turns_read_back(turns):
    shown = "".join(TEMPLATE.turn(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in TEMPLATE.read(shown)] == turns


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escape_leaves_no_control_string(text):
    escaped = TEMPLATE.escape(text)
    assert TEMPLATE.unescape(escaped) == text
    assert not any(c in escaped for c in TEMPLATE.controls)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), texts), max_size=5))
def test_masked_tokens_cover_learned_turns_exactly(turns):
    shown, spans = "", []
    for role, text in turns:
        part, a, b = TEMPLATE.turn(role, text)
        if role == "assistant" and b > a:
            spans.append((len(shown) + a, len(shown) + b))
        shown += part
    ids, starts, ends = encoder(_vocabulary("byte_bpe_50k.json"), TEMPLATE)(shown)
    assert masked_spans(starts, ends, loss_mask(starts, ends, spans)) == spans


def test_loss_mask_meets_spans_as_a_scan_does():
    rng = np.random.default_rng(0)
    for _ in range(200):
        starts = np.sort(rng.integers(0, 40, 15))
        ends = np.maximum.accumulate(starts + rng.integers(0, 4, 15))
        cuts = np.sort(rng.choice(45, 6, replace=False))
        spans = [(int(a), int(b)) for a, b in cuts.reshape(-1, 2)]
        plain = [any(a < e and s < b and s < e for a, b in spans) for s, e in zip(starts, ends)]
        assert loss_mask(starts, ends, spans).tolist() == plain


def test_edge_rows(spark):
    long = "long [INST] " * 20_000
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", None, 1), (2, 0, None, "no role", 2), (2, None, "assistant", "first", 2),
            (3, 0, "user", "", 1), (3, 0, "user", "", 1), (3, 0, "user", "b", 1), (3, 0, "assistant", "tie", 1),
            (None, 0, "assistant", "a", 1), (None, 0, "assistant", "a", 1), (None, 3, "tool", "x[/ROLE]</s>", 1),
            (4, 1, "assistant", long, 1), (4, 2, "assistant", "\U0001f600 你好 <|endoftext|>", 1),
            (-7, 0, "user", "</s>[INST] ok [/INST]", 1), (-7, 1, "assistant", "</s>[INST] ok [/INST]", 1)]
    # Texts of equal turns and roles follow their hash; here only rows (3, 0, user) tie.
    ties = spark.createDataFrame([(t,) for t in ("", "b")], "t string").orderBy(F.xxhash64("t")).collect()
    expected = want([r for r in rows if r[0] != 3])
    turns = [("assistant", "tie"), *[("user", t["t"]) for t in ties for _ in range(2 if t["t"] == "" else 1)]]
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    got = run(spark, rows)
    three = next(r for r in got if r[0] == 3)
    assert three[1:5] == (4, hashlib.sha256(whole.encode()).hexdigest(), 3, hashlib.sha256(b"tie").hexdigest())
    assert [r for r in got if r[0] != 3] == expected
    assert run(spark, []) == []


def test_one_conversation_holds_most_rows(spark):
    """A hot conversation is formatted in many pieces, by many tasks, and its digest is that of the whole."""
    rows = [(9, i, ("user", "assistant")[i % 2], f"turn {i} [INST]", 0) for i in range(3000)]
    rows += [(i, j, ("user", "assistant")[j], f"{i}", 0) for i in range(200) for j in range(2)]
    rows = [r for r in rows if r[0] != 9 or r[3].startswith("turn")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # rows are few
    try:
        pieces = format_chats(df, _vocabulary("byte_bpe_50k.json"), piece_chars=2000)
        hot = pieces.where("conv_id = 9").select("part", F.length("text").alias("n"), "whole").collect()
        assert len({r["part"] for r in hot}) > 1 and max(r["n"] for r in hot) < 2100 and not any(r["whole"] for r in hot)
        assert run(spark, rows, piece_chars=2000) == want(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_are_those_of_the_texts_and_marks(spark):
    rows = [(1, 0, "user", "Hello there", 1), (1, 1, "assistant", "General Kenobi", 1)]
    row = format_chats(spark.createDataFrame(rows, SCHEMA), _vocabulary("byte_bpe_50k.json")).first()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(_vocabulary("byte_bpe_50k.json"))
    learned = [i for i, m in zip(row["ids"], row["loss"]) if m]
    assert row["text"] == "[INST]Hello there[/INST]General Kenobi</s>"
    assert learned == plain.encode("General Kenobi").ids
    assert [i for i in row["ids"] if i < 50257] == plain.encode("Hello there").ids + learned


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError):
        Template(controls=("<s>",))
    with pytest.raises(ValueError):
        Template(controls=(*TEMPLATE.controls, "<a<"))
