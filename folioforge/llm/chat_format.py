"""Conversations rebuilt from their event logs and rendered with a chat template, by DataFrame operations only.

An event has a conversation, a turn, a place in the turn, a kind, a role and a text. Kinds: `message` starts a message with its
text, `delta` adds to the turn's text, `edit` replaces it, `regenerate` throws it away. A conversation's log is sorted by
turn and place, then folded.

The template is <|start|>role<|sep|>text<|end|> for each message. Inside roles and texts every `<`, `[` and backslash is
followed by a backslash, so no control string of this or of other common templates is left in them, and what follows a
special character tells exactly what was there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
LEARNED = "assistant"
EVENT = "turn bigint, place bigint, kind string, role string, text string"


def escape(x: Column) -> Column:
    return F.regexp_replace(x, r"([<\[\\])", r"$1\\")


def unescape(x: Column) -> Column:
    return F.regexp_replace(x, r"([<\[\\])\\", "$1")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, messages): the final messages, array<struct<role, text>>, of events(conv_id, turn, place, kind, role, text).

    Null roles and texts count as empty, an unknown or null kind as `message`; null turns and places come first. Ties
    are ordered by kind (message, regenerate, edit, delta), role and text, and repeated message rows give repeated messages. Events without a message before them
    make one. Rows of a null conv_id are one conversation. A conversation is one row of the result, so its log meets in one task; it is the
    only group that does.
    """
    kind = F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise("message")
    rank = F.when(kind == "message", 0).when(kind == "regenerate", 1).when(kind == "edit", 2).otherwise(3)
    event = F.struct("turn", "place", rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    logs = events.select("conv_id", event.alias("e")).groupBy("conv_id").agg(F.array_sort(F.collect_list("e")).alias("log"))
    at = F.sequence(F.lit(1), F.size("log"))
    new = lambda i: (i == 1) | (F.element_at("log", i)["rank"] == 0) | ~F.element_at("log", i)["turn"].eqNullSafe(F.element_at("log", F.greatest(i - 1, F.lit(1)))["turn"])
    logs = logs.withColumn("starts", F.filter(at, new))
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("log") + 1))
    logs = logs.withColumn("parts", F.transform(F.arrays_zip("starts", ends.alias("ends")), lambda x: F.slice("log", x["starts"], x["ends"] - x["starts"])))

    def folded(part: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(part))
        reset = F.array_max(F.filter(places, lambda i: (F.element_at(part, i)["rank"] < 3) | (i == 1)))
        live = F.slice(part, reset, F.size(part))
        text = F.array_join(F.transform(live, lambda e: F.when(e["rank"] == 1, F.lit("")).otherwise(e["text"])), "")
        return F.struct(F.element_at(part, 1)["role"].alias("role"), text.alias("text"))

    return logs.select("conv_id", F.transform("parts", folded).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the rendered text and the places (start from 0, length; code points) of what is learned: each escaped assistant text."""
    piece = lambda m: F.concat(F.lit(START), escape(m["role"]), F.lit(SEP), escape(m["text"]), F.lit(END))
    out = conversations.select("conv_id", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), piece(m).alias("piece"), F.length(escape(m["text"])).alias("n"))).alias("m"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        to = acc["at"] + F.length(m["piece"])
        span = F.array(F.struct((to - len(END) - m["n"]).alias("start"), m["n"].alias("length")))
        return F.struct(to.alias("at"), F.when(m["role"] == LEARNED, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return out.select("conv_id", F.array_join(F.transform("m", lambda m: m["piece"]), "").alias("formatted"), F.aggregate("m", empty, step)["spans"].alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text): roles and texts parsed from the rendered text alone, and the unescaped text under the loss mask."""
    parts = F.filter(F.split("formatted", r"\Q" + START + r"\E"), lambda p: p != "")
    turn = lambda p: F.struct(unescape(F.substring_index(p, SEP, 1)).alias("role"), unescape(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"))
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]))), "")
    return rendered.select("conv_id", F.transform(parts, turn).alias("turns"), learned.alias("loss_text"), "formatted")


def digest(rendered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read back from the rendered text."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(rendered).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def as_events(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log with one message event each."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lit(None).cast("long").alias("place"), F.lit("message").alias("kind"), "role", "text")
