"""Quotation linking: messages without their quotes, in the order of replies.

Quoted lines are told by ``>`` marks; their number is the level.  A passage is a
run of lines of one level, up to an empty line.  Passages and their sentences are
normalised and hashed, and quoted ones are joined to the messages that wrote
them.  A message answers the latest of its own conversation's earlier messages
that it quotes at the first level, so replies make trees, in which each message
finds its thread and its depth by doubling pointers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.tables import stored
from tillweave.operators.positions import number_rows

#: Sentences of so many words and more are looked up in all conversations where a whole
#: passage is not found; shorter ones tell little and are looked up in their own only.
SENTENCE_WORDS = 4

_MARKS = re.compile(r"[ \t]*(?:>[ \t]?)+")
_SENTENCE_END = re.compile(r"(?<=[.!?]) ")
#: A line that only says who wrote what is quoted below it.
_ATTRIBUTION = re.compile(r"(?:On|Am|Le|El) .{3,200}(?:wrote|schrieb|écrit|escribió) ?:\s*$")


@dataclass
class Message:
    own_text: str = ""
    #: Passages written here.
    own: list[str] = field(default_factory=list)
    #: (level, passage) of quoted ones, in order.
    quoted: list[tuple[int, str]] = field(default_factory=list)


def normalised(lines: list[str]) -> str:
    """Lines as one, ASCII in lower case, runs of white space as one space."""
    joined = " ".join(" ".join(lines).split())
    return joined.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def parsed(text: str | None) -> Message:
    """A message taken apart; null and empty texts have no passages."""
    message = Message()
    kept: list[str] = []
    level, passage = 0, []

    def close() -> None:
        body = normalised(passage)
        if body:
            if level:
                message.quoted.append((level, body))
            else:
                message.own.append(body)
        passage.clear()

    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        depth = marks.group().count(">") if marks else 0
        body = line[marks.end() :] if marks else line
        if depth != level or not body.strip():
            if depth and not level and passage and _ATTRIBUTION.match(passage[-1].strip()):
                passage.pop()
                kept.pop()
            close()
            level = depth
        if body.strip():
            passage.append(body)
        if not depth:
            kept.append(body)
    close()
    message.own_text = "\n".join(kept).strip("\n")
    return message


def parts_of(passage: str) -> dict[str, bool]:
    """The passage and, if there are several, its sentences; whether each is sought everywhere."""
    found = {passage: True}
    for sentence in _SENTENCE_END.split(passage):
        found.setdefault(sentence, len(sentence.split(" ")) >= SENTENCE_WORDS)
    return found


_KEYS = "array<struct<key:binary,wide:boolean>>"
_PARSED = (
    "conv_id bigint, turn bigint, role string, own_text string, levels int,"
    f" own {_KEYS}, quoted array<struct<level:int,keys:{_KEYS}>>"
)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh128_digest

    def keys(parts: dict[str, bool]) -> list[dict]:
        return [
            {"key": xxh128_digest(part.encode("utf-8", "surrogatepass"), 42), "wide": wide}
            for part, wide in parts.items()
        ]

    keys_type = pa.list_(pa.struct([("key", pa.binary()), ("wide", pa.bool_())]))
    quoted_type = pa.list_(pa.struct([("level", pa.int32()), ("keys", keys_type)]))
    for batch in W.gathered(batches):
        messages = [parsed(t) for t in batch.column(3).to_pylist()]
        own = []
        for message in messages:
            written: dict[str, bool] = {}
            for passage in message.own:
                for part, wide in parts_of(passage).items():
                    written[part] = wide or written.get(part, False)
            own.append(keys(written))
        quoted = [
            [{"level": level, "keys": keys(parts_of(p))} for level, p in m.quoted]
            for m in messages
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(2),
                pa.array([m.own_text for m in messages], pa.string()),
                pa.array([max((lv for lv, _ in m.quoted), default=0) for m in messages], pa.int32()),
                pa.array(own, keys_type),
                pa.array(quoted, quoted_type),
            ],
            names=["conv_id", "turn", "role", "own_text", "levels", "own", "quoted"],
        )


def _origins(messages: DataFrame) -> DataFrame:
    """Per quoted passage (conv_id, turn, place, level): from_conv and from_turn, null if unknown.

    A passage is taken to come from the first message of its conversation that
    wrote it, if that is an earlier one, and else from the first message of the
    least other conversation that did.  The whole passage goes before its
    sentences, those of ``SENTENCE_WORDS`` before shorter ones, an earlier one
    before a later.  Short sentences count only within the conversation.
    """
    quoted = messages.select(
        "conv_id", "turn", F.posexplode("quoted").alias("place", "quote")
    ).select("conv_id", "turn", "place", F.col("quote.level").alias("level"), "quote.keys")
    parts = quoted.select(
        "conv_id", "turn", "place", "level", F.posexplode("keys").alias("part", "sought")
    )
    keys = stored(
        parts.select("conv_id", "turn", "place", "level", "part", "sought.key", "sought.wide").distinct(),
        "quotes",
    )
    # Only what somebody quotes is looked for, and each message's first place of it kept.
    written = (
        messages.select("conv_id", "turn", F.explode("own").alias("part"))
        .select("conv_id", "turn", "part.key", "part.wide")
        .where("conv_id IS NOT NULL AND turn IS NOT NULL")
    )
    sought = written.join(keys.select("key").distinct(), "key", "left_semi")
    by_conversation = stored(
        sought.groupBy("key", "conv_id").agg(
            F.min("turn").alias("first_turn"),
            F.min(F.when(F.col("wide"), F.col("turn"))).alias("wide_turn"),
        ),
        "written",
    )
    # The two least conversations of a key, cut to two a task before the shuffle:
    # one of them is not the quoting one.
    rank = F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))
    place = F.struct(F.col("conv_id").alias("from_conv"), F.col("wide_turn").alias("from_turn"))
    least = (
        by_conversation.where("wide_turn IS NOT NULL")
        .withColumn("_rank", rank)
        .where("_rank <= 2")
        .groupBy("key")
        .agg(F.min(place).alias("least"), F.max(place).alias("next"))
    )
    here = by_conversation.select(
        "key", F.col("conv_id").alias("_conv"), F.col("first_turn").alias("_turn")
    )
    matched = (
        keys.join(here, (keys["key"] == here["key"]) & (keys["conv_id"] == here["_conv"]), "left")
        .drop(here["key"])
        .join(least, "key", "left")
    )
    inside = F.when(
        F.col("_turn") < F.col("turn"),
        F.struct(F.col("_conv").alias("from_conv"), F.col("_turn").alias("from_turn")),
    )

    def other(place: str) -> Column:
        own = F.col(f"{place}.from_conv").eqNullSafe(F.col("conv_id"))
        return F.when(F.col("wide") & ~own, F.col(place))

    found = matched.withColumn("origin", F.coalesce(inside, other("least"), other("next")))
    ranked = F.struct((~F.col("wide")).alias("short"), "part", "origin")
    return (
        found.groupBy("conv_id", "turn", "place", "level")
        .agg(F.min(F.when(F.col("origin").isNotNull(), ranked)).alias("best"))
        .select(
            "conv_id",
            "turn",
            "place",
            "level",
            F.col("best.origin.from_conv").alias("from_conv"),
            F.col("best.origin.from_turn").alias("from_turn"),
        )
    )


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, reply_depth) of every message with a parent.

    Each round doubles how far up a message looks; parents are always earlier
    turns, so the rounds end after the logarithm of the deepest thread.
    """
    up = stored(
        parents.select(
            "conv_id", "turn", F.col("reply_to").alias("to"), F.lit(1).cast("bigint").alias("far")
        ),
        "replies",
    )
    while True:
        above = up.select(
            F.col("conv_id").alias("_conv"),
            F.col("turn").alias("_turn"),
            F.col("to").alias("_to"),
            F.col("far").alias("_far"),
        )
        onward = up.join(
            above, (up["conv_id"] == above["_conv"]) & (up["to"] == above["_turn"]), "left"
        )
        if onward.where("_to IS NOT NULL").isEmpty():
            return up.select(
                "conv_id", "turn", F.col("to").alias("thread_turn"), F.col("far").alias("reply_depth")
            )
        up = stored(
            onward.select(
                "conv_id",
                "turn",
                F.coalesce("_to", "to").alias("to"),
                (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far"),
            ),
            "replies",
        )


def quote_links(conversations: DataFrame) -> DataFrame:
    """Every quoted passage of ``conversations`` and where it comes from; see ``_origins``."""
    return _origins(_parsed(conversations))


def _parsed(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text").mapInArrow(_hashed, _PARSED)
    return stored(rows, "messages")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """Per row of ``conversations``: the message without quotes, and its place among replies.

    ``reply_to`` is the turn it answers, null if it quotes nothing of its own
    conversation; ``thread_turn`` is the turn its thread begins with, itself
    included; ``position`` counts the messages of the conversation by thread,
    depth and turn.  Quotes from other conversations are counted as linked but
    make no reply.  A null or empty text has no own text and no quotes.  A
    message without conv_id or turn answers nothing and is answered by nothing;
    null ids are one conversation.  Rows that repeat a turn are answered as one
    and numbered one after another.  An empty table gives no row.
    """
    messages = _parsed(conversations)
    origins = stored(_origins(messages), "origins")
    same = F.col("from_conv") == F.col("conv_id")
    counted = origins.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quotes"),
        F.count("from_turn").alias("n_linked"),
        F.max(F.when(same & (F.col("level") == 1), F.col("from_turn"))).alias("reply_to"),
    )
    counted = stored(counted, "quote-counts")
    threads = _threads(counted.where("reply_to IS NOT NULL"))
    known = counted.join(threads, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("_conv"),
        F.col("turn").alias("_turn"),
        "n_quotes",
        "n_linked",
        "reply_to",
        "thread_turn",
        "reply_depth",
    )
    rows = messages.join(
        known,
        messages["conv_id"].eqNullSafe(known["_conv"])
        & messages["turn"].eqNullSafe(known["_turn"]),
        "left",
    ).select(
        "conv_id",
        "turn",
        "role",
        "own_text",
        "levels",
        F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        "reply_to",
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("reply_depth", F.lit(0)).cast("bigint").alias("reply_depth"),
    )
    order = ["conv_id", "thread_turn", "reply_depth", "turn", "role", "own_text"]
    numbered = stored(number_rows(rows, order, "_number"), "numbered")
    first = numbered.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_number").alias("_first"))
    return numbered.join(first, numbered["conv_id"].eqNullSafe(first["_conv"])).select(
        *rows.columns, (F.col("_number") - F.col("_first")).alias("position")
    )
