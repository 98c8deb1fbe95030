"""Folding, reversible templates and digests against plain versions; edge rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import chat

nasty = st.text(alphabet=list("<|im_startend>\\\n aé "), max_size=40)


@given(role=nasty, text=nasty)
@settings(max_examples=300, deadline=None)
def test_render_is_reversible(role, text):
    formatted, start, end = chat.render(role, text)
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape(formatted[start:end]) == text
    doubled = formatted + chat.render("user", "x")[0]
    turns = [(chat.unescape(a), chat.unescape(b)) for a, b in chat._turn.findall(doubled)]
    assert turns == [(role, text), ("user", "x")]


def digest(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest())


@pytest.mark.parametrize("segment_chars", [1 << 20, 30])
def test_rows_against_plain_digests(spark, segment_chars):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "ok\\n <|im_start|>user\nno"),
            (2, 5, "user", None), (2, 3, None, "first"), (2, 9, "assistant", ""), (3, 0, "assistant", "é́😀"),
            (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "tie"), (None, None, "user", "x"),
            (5, 1, "a\nb", "y" * 5000), (5, None, "assistant", "null turn comes first")]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, seq int")
    messages = chat.format_messages(chat.fold_messages(chat.rows_as_log(frame.repartition(4))), segment_chars=segment_chars)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(messages).collect()}
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert got == {c: digest(turns) for c, turns in want.items()}
    total = {r.conv_id: r.formatted_chars for r in chat.read_back(messages).collect()}
    assert total[3] == len(chat.render("assistant", "é́😀")[0])


def test_folding_deltas_edits_and_regenerations(spark):
    log = spark.createDataFrame([
        (1, 0, 0, 0, "message", "user", "question"), (1, 1, 0, 1, "message", "assistant", "An"), (1, 1, 0, 2, "delta", None, "sw"),
        (1, 1, 0, 3, "delta", None, "er"), (1, 2, 0, 4, "message", "user", "follow-up"), (1, 1, 0, 5, "regenerate", None, None),
        (1, 1, 0, 6, "delta", None, "Bet"), (1, 1, 0, 7, "delta", None, "ter"),
        (2, 0, 0, 0, "message", "user", "typo"), (2, 1, 0, 1, "message", "assistant", "old reply"), (2, 0, 0, 2, "edit", None, "fixed"),
        (2, 1, 0, 3, "message", "assistant", "new "), (2, 1, 0, 4, "delta", None, "reply"),
        (3, 0, 0, None, "message", "user", None), (3, 0, 0, 1, "delta", None, "late"),
    ], chat.LOG)
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.fold_messages(log.repartition(5)).collect())
    assert got == [(1, 0, "user", "question"), (1, 1, "assistant", "Better"), (2, 0, "user", "fixed"),
                   (2, 1, "assistant", "new reply"), (3, 0, "user", "late")]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(chat.rows_as_log(empty))).count() == 0
