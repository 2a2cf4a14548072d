"""Chat formatting: round trips, loss masks and merged turns against plain Python."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from holdfast.llm import chat

HARD = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\/INST] <\\s> [MORE] [\\MORE]", " [MORE] ", "[", "<", "", " ", "[ROLE x] a [/ROLE]", "[[INST]<</s>", "\n[/INST",
        "back\\slash \\[SYS] $1 \\1", "É ß 漢字 😀 [SYS]", "<s[INST]>", "INST]", "s>", "NUL \x00 too"]
ROLES = ["user", "assistant", "system", "tool ]x[", "", None, "MORE] "]


@pytest.fixture(scope="module")
def hard_turns(spark):
    rows = [(c, t, ROLES[(c * 3 + t // (1 + c % 3)) % len(ROLES)], HARD[(c * 5 + t) % len(HARD)], "mine", 1) for c in range(20) for t in range(c * 2 + 1)]
    rows += [(50, t, "user" if t < 40 else "assistant", None if t % 5 == 0 else f"t{t}", "mine", 1) for t in range(60)]
    rows += [rows[3], rows[3], (3, None, "user", "no number", "x", 2), (3, -5, "user", "before", "x", 2), (None, 1, "user", "alone", "x", 2), (None, 2, "assistant", "alone too", "x", 2)]
    rows += [(60, 1, "assistant", "long [INST] words \\ " * 40_000, "x", 3)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, part int").repartition(4)


def said(rows):
    """Turns of each conversation in their defined order."""
    out = {}
    for r in rows:
        if r.conv_id is not None:
            out.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in out.items()}


@pytest.mark.parametrize("part_turns", [1, 7, 256])
def test_round_trip(hard_turns, part_turns):
    want = said(hard_turns.collect())
    parts = chat.format_conversations(hard_turns, part_turns=part_turns)
    whole = chat.whole_conversations(parts)
    got = whole.select("conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got if r.conv_id is not None} == want
    for r in got:
        if r.conv_id is not None:
            assert r.loss == "".join(text for role, text in want[r.conv_id] if role == "assistant")
    assert sorted(r.formatted for r in got if r.conv_id is None) == ["<s>alone too</s>", "[INST] alone [/INST]"]
    if part_turns < 60:
        assert parts.where("conv_id = 50").count() > 1


def test_parts_do_not_change_the_text(hard_turns):
    texts = [
        {r.conv_id: r.formatted for r in chat.whole_conversations(chat.format_conversations(hard_turns, part_turns=n)).where("conv_id is not null").collect()}
        for n in (1, 5, 1000)]
    assert texts[0] == texts[1] == texts[2]


def test_adjacent_turns_merge(hard_turns):
    text = chat.whole_conversations(chat.format_conversations(hard_turns, part_turns=7)).where("conv_id = 50").first().formatted
    assert text.count("[INST] ") == 1 and text.count("<s>") == 1 and text.count(" [MORE] ") == 58


def test_texts_hold_no_mark(spark):
    template = chat.DEFAULT
    escaped = spark.createDataFrame([(t,) for t in HARD], "t string").select(template.escape(F.col("t")).alias("e"), "t")
    for r in escaped.select("e", "t", template.unescape(F.col("e")).alias("back")).collect():
        assert not re.search(rf"[\[<]({template.stem})", r.e) and r.back == r.t
        if not re.search(rf"[\[<]\\*({template.stem})", r.t):
            assert r.e == r.t


def test_loss_spans_cover_only_learned_text(hard_turns):
    for r in chat.format_conversations(hard_turns, part_turns=7).collect():
        marks = "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
        assert not re.search(rf"[\[<]({chat.DEFAULT.stem})", marks)


def test_no_rows(hard_turns):
    assert chat.digests(chat.whole_conversations(chat.format_conversations(hard_turns.where("false")))).count() == 0


def test_query_digests(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    want = said(rows) | {chat.CONV_ID: chat.EXTRA}
    got = {r.conv_id: r for r in chat.op12_chat_format(spark, sf_dir).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        learned = "".join(text for role, text in turns if role == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(learned)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
