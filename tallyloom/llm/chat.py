"""Conversations from event logs: fold messages, render them by a template, read the output back.

A log has rows (conv_id, turn, part, seq, kind, role, text).  A message is named by
conversation, turn and part (rows of one turn beside each other).  In order of
``seq`` its events mean:

* ``message``: it begins, with this role and text;
* ``delta``: this text is appended (a streamed piece);
* ``edit``: this text replaces what was there;
* ``regenerate``: what was there goes, deltas follow.

An edit or a regeneration also withdraws the later turns of its conversation that
had begun before it: they answered what is no longer said.

Output is rows of formatted text in order of conversation and turn.  A row holds a
whole conversation, or a stretch of one beyond ``SEGMENT_CHARS`` characters; a
conversation is the concatenation of its rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import batches, frugal, materialise

START, END = "<|im_start|>", "<|im_end|>"
SEGMENT_CHARS = 1 << 20
RESETS = ("message", "edit", "regenerate")
LOG = "conv_id long, turn long, part int, seq long, kind string, role string, text string"


def rows_as_log(rows: DataFrame) -> DataFrame:
    """A log of one ``message`` per row (conv_id, turn, role, text).

    Rows of one turn are messages beside each other, by role and text; equal rows
    stay as many as they are.  A null role or text counts as empty, a null turn
    comes first, a null conversation is one of its own.
    """
    tie = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "conv_id", "turn", F.row_number().over(tie).alias("part"), F.coalesce("turn", F.lit(-1)).alias("seq"),
        F.lit("message").alias("kind"), "role", "text")


def fold_messages(log: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, text): what each message finally says; withdrawn ones are gone.

    Only one message's events ever meet in a row.  Withdrawal looks at one small
    row per message; its window runs over a conversation's messages, not their text.
    Events without a sequence number come first; equal numbers go by kind, role, text.
    """
    key = ["conv_id", "turn", "part"]
    seq = F.coalesce("seq", F.lit(-(1 << 62)))
    later = F.when(F.col("kind").isin("edit", "regenerate"), seq)
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    cuts = log.groupBy("conv_id", F.coalesce("turn", F.lit(-1)).alias("turn")).agg(F.max(later).alias("reset")).withColumn(
        "cut", F.max("reset").over(earlier)).where("cut is not null").select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "cut")
    live = log.join(cuts, log["conv_id"].eqNullSafe(F.col("c")) & (F.coalesce(log["turn"], F.lit(-1)) == F.col("t")),
                    "left").where(F.col("cut").isNull() | (seq > F.col("cut")))
    event = F.struct(seq.alias("seq"), (F.col("kind") == "delta").alias("more"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    folded = live.groupBy(*key).agg(F.sort_array(F.collect_list(event)).alias("events"))
    begins = F.transform("events", lambda e, i: F.when(~e["more"], i + 1).otherwise(1))
    last = F.slice("events", F.array_max(begins), F.size("events"))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r != "")
    return folded.select(*key, F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                         F.array_join(F.transform(last, lambda e: e["text"]), "").alias("text"))


def escape(text: str) -> str:
    """No control string is left: every ``<|`` becomes ``<\\|``, a backslash two."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), text)


_escaped = re.compile(r"\\(.)", re.DOTALL)
_turn = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, where its text begins, where it ends)."""
    head = f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def format_messages(messages: DataFrame, loss_role: str = "assistant", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """(conv_id, turn, part, text, loss array<struct<start, end>>): formatted text in order.

    ``turn`` and ``part`` are those of the row's first message; ``loss`` are the
    stretches of the row's text (code points) that the loss is taken over.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    out = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                     ("loss", pa.list_(span))])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            head, held, size, loss = None, [], 0, []
            for part in parts:
                for conv, turn, n, role, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if held and (conv != head[0] or size >= segment_chars):
                        yield *head, "".join(held), loss
                        held, size, loss = [], 0, []
                    if not held:
                        head = (conv, turn, n)
                    formatted, start, end = render(role, text)
                    if role == loss_role:
                        loss.append({"start": size + start, "end": size + end})
                    held.append(formatted)
                    size += len(formatted)
            if held:
                yield *head, "".join(held), loss

        yield from batches(segments(), out, 64)

    order = ["conv_id", "turn", "part"]
    return (messages.select(*order, "role", "text").repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(frugal(run), "conv_id long, turn long, part int, text string, loss array<struct<start:long,end:long>>"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted rows.

    Turns are parsed from the text and unescaped, the loss is cut out by its
    stretches.  A digest needs a conversation's rows one after the other: they
    are read as a stream, one row at a time, whatever the conversation's size.
    """
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            state = None
            for part in parts:
                for conv, text, loss in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if state is None or conv != state[0]:
                        if state:
                            yield state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]
                        state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for m in _turn.finditer(text):
                        state[1] += 1
                        state[2].update(f"{unescape(m.group(1))}\n{unescape(m.group(2))}\n".encode())
                    for span in loss:
                        said = unescape(text[span["start"]:span["end"]])
                        state[3] += len(said)
                        state[4].update(said.encode())
                    state[5] += len(text)
            if state:
                yield state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        yield from batches(digests(), out)

    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
            .select("conv_id", "text", "loss").mapInArrow(
                frugal(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                     "formatted_chars long"))


def format_conversations(log: DataFrame, **options) -> DataFrame:
    """The formatted rows of a log, written to the shared folder."""
    return materialise(format_messages(fold_messages(log), **options), "chat")
