"""Chat formatting from an event log: fold each conversation's events into messages, then render.

**Log.** One row per event: ``conv_id``, ``seq`` (order within the conversation), ``msg`` (place of the
message), ``kind`` and ``role`` / ``text``. Kinds: ``open`` starts a message with its role, ``delta`` adds
streamed text, ``edit`` replaces the text so far, ``regenerate`` discards it, further deltas follow.
Events are partitioned by message, sorted by sequence and folded: the text is what the last ``edit`` or
``regenerate`` set, and the deltas after it. Only final messages travel on to their conversation.

**Template.** ``<turn role>`` newline, text, newline ``</turn>`` newline. Markers are the only places with
a bare ``<``: inside roles and texts a backslash becomes two, ``<`` and ``>`` get one before them. So any
control string inside a text stays text, and reading back is exact. The loss mask lists the code point
ranges of assistant texts.

Defined results: null roles and texts are empty; a message without ``open`` has an empty role; equal
``seq`` values are ordered by kind and text; conversations without events give no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn ", "</turn>\n"
DELTA_CHARS = 400
# escaped text: no bare marker sign in it; a body ends with the line break before its end marker
PLAIN = r"[^<>\\]*+(?:\\.[^<>\\]*+)*+"
TOKEN = re.compile(rf"<turn ({PLAIN})>\n({PLAIN})</turn>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text) for each message of the log."""
    event = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = events.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(-1))
    last = F.array_max(resets)
    kept = F.filter("log", lambda e, i: (i >= F.col("last")) & (e["kind"].isin("edit", "delta")))
    opened = F.filter("log", lambda e: e["kind"] == "open")
    return grouped.withColumn("last", last).select(
        "conv_id",
        "msg",
        F.coalesce(F.get(opened, F.lit(-1) + F.size(opened))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"),
    )


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>])", r"\\$1")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) per conversation; ``loss`` holds start and end of each masked range.

    Rendering is done message by message; the conversation only joins the parts.
    """
    body = escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(">\n"))
    parts = messages.select(
        "conv_id",
        F.struct(
            "msg", "role", head.alias("head"), body.alias("body"),
            F.char_length(head).cast("bigint").alias("lead"), F.char_length(body).cast("bigint").alias("size"),
        ).alias("part"),
    )
    tail = "\n" + CLOSE
    turns = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["lead"]
        end = begin + p["size"]
        spans = F.when(p["role"] == "assistant", F.concat(acc["spans"], F.array(begin, end))).otherwise(acc["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    masked = F.aggregate("parts", start, step, lambda acc: acc["spans"])
    return turns.select("conv_id", formatted.alias("formatted"), masked.alias("loss"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation; anything else is refused."""
    turns, at = [], 0
    while at < len(formatted):
        m = TOKEN.match(formatted, at)
        if m is None or not m[2].endswith("\n"):
            raise ValueError(f"no turn at position {at}")
        turns.append((unescape(m[1]), unescape(m[2][:-1])))
        at = m.end()
    return turns


def read_back(rendered: DataFrame) -> DataFrame:
    """Counts and digests of rendered conversations, taken from their text and loss mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                turns = parse(text)
                every = "".join(f"{role}\n{body}\n" for role, body in turns)
                masked = "".join(unescape(text[s:e]) for s, e in zip(loss[0::2], loss[1::2]))
                digest = [hashlib.sha256(t.encode()).hexdigest() for t in (every, masked)]
                rows.append((conv, len(turns), digest[0], len(masked), digest[1], len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, TYPES)], NAMES)

    return rendered.select("conv_id", "formatted", "loss").mapInArrow(run, DIGESTS)


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def as_events(conversations: DataFrame) -> DataFrame:
    """A log whose fold gives the rows of ``conversations`` (conv_id, turn, role, text).

    Every message is opened; a first attempt is streamed and discarded by a regeneration (assistants) or
    replaced by an edit (others); the text then arrives in deltas of ``DELTA_CHARS`` code points. Rows
    with the same turn are messages of their own, ordered by role and text.
    """
    text = F.coalesce("text", F.lit(""))
    pieces = F.greatest(F.ceil(F.char_length(text) / DELTA_CHARS), F.lit(1))
    delta = F.transform(
        F.sequence(F.lit(0), (pieces - 1).cast("int")),
        lambda i: F.struct(
            (i + 3).cast("bigint").alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
            F.substring(text, i * DELTA_CHARS + 1, F.lit(DELTA_CHARS)).alias("text"),
        ),
    )

    def one(seq: int, kind: Column, role: Column, body: Column) -> Column:
        return F.struct(F.lit(seq).cast("bigint").alias("seq"), kind.alias("kind"), role.cast("string").alias("role"), body.cast("string").alias("text"))

    none = F.lit(None).cast("string")
    redo = F.when(F.col("role") == "assistant", F.lit("regenerate")).otherwise(F.lit("edit"))
    first = F.array(one(0, F.lit("open"), F.col("role"), none), one(1, F.lit("delta"), none, F.substring(text, 1, 20)), one(2, redo, none, F.lit("")))
    copies = conversations.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    each = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), "copy")
    rows = each.select("conv_id", message.alias("msg"), F.explode(F.concat(first, delta)).alias("e"))
    return rows.select("conv_id", "msg", "e.seq", "e.kind", "e.role", "e.text")
