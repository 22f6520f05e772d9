"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

A log holds one row per event: conv_id, position (of the message in its conversation),
message_id, seq, kind, role, text. Kinds: ``start`` (opens a message and gives its role),
``delta`` (appends text), ``edit`` (its text replaces what the message held), ``regenerate``
(empties the message; the deltas that follow write it anew). The log is partitioned by
conversation and message, sorted by seq, and each message is folded to its final text; the
messages of a conversation, sorted by position, are then rendered. Folding messages first
pre-aggregates the log, so that a conversation with very many events arrives at its last
step as one row per message. A rendered conversation is one value and so must fit in a row.

Rendering. A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so that no text can hold a marker; the way
back undoes both in the opposite order. The loss mask is a list of spans (start, length, in
characters of the formatted string): the texts of the ``assistant`` turns.

Defined cases: a null text or role is empty; a null conv_id is a conversation of its own;
turns with the same number are all kept, in the order of their numbers, then roles, then texts;
events that share a seq are folded in the order of kind, role and text, and an event that
was delivered twice counts once; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNT_ROLE = "assistant"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def turn_events(conversations: DataFrame, delta_chars: int = 256) -> DataFrame:
    """The event log of a table of finished turns: a start and the text in streamed deltas."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), 0)
    none = F.lit(None).cast("string")
    opened = F.array(F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), role.alias("role"), none.alias("text")))
    deltas = F.transform(
        parts,
        lambda t, i: F.struct((i + 1).alias("seq"), F.lit("delta").alias("kind"), none.alias("role"), t.alias("text")),
    )
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("position"),
            F.monotonically_increasing_id().alias("message_id"), F.concat(opened, deltas).alias("events"),
        )
        .select("conv_id", "position", "message_id", F.explode("events").alias("e")).select("conv_id", "position", "message_id", "e.*")
    )


def messages(events: DataFrame) -> DataFrame:
    """conv_id, position, message_id, role, text: every message as its events leave it."""
    event = F.struct("seq", "kind", F.col("role"), F.col("text"))
    log = events.groupBy("conv_id", "position", "message_id").agg(F.array_sort(F.collect_set(event)).alias("log"))
    anew = F.filter("log", lambda e: e["kind"].isin("edit", "regenerate"))
    since = F.coalesce(F.element_at(F.transform(anew, lambda e: e["seq"]), -1), F.element_at("log", 1)["seq"])
    texts = F.filter("log", lambda e: (e["seq"] >= F.col("since")) & e["kind"].isin("edit", "delta"))
    roles = F.filter("log", lambda e: e["role"].isNotNull())
    return (
        log.withColumn("since", F.when(F.size(anew) > 0, since).otherwise(F.element_at("log", 1)["seq"]))
        .select(
            "conv_id", "position", "message_id",
            F.when(F.size(roles) > 0, F.element_at(roles, -1)["role"]).otherwise("").alias("role"),
            F.array_join(F.transform(texts, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"),
        )
    )


def formatted(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length) per conversation."""
    turn = messages(events).withColumn("body", escaped(F.col("text"))).withColumn("head", F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)))
    order = ["position", "role", "text", "message_id"]
    placed = turn.withColumn("piece", F.concat("head", "body", F.lit(END))).withColumn(
        "at",
        F.coalesce(
            F.sum(F.length("piece").cast("long")).over(
                Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0).cast("long"),
        ),
    )
    span = F.when(
        F.col("role") == LEARNT_ROLE,
        F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")),
    )
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts``, both taken from the formatted string."""
    pieces = F.slice(F.split("formatted", r"<\|im_end\|>"), 1, F.size(F.split("formatted", r"<\|im_end\|>")) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SEP, 1)
        return F.struct(
            unescaped(F.substring(role, len(START) + 1, F.length(role))).alias("role"),
            unescaped(F.substring(piece, F.length(role) + len(SEP) + 1, F.length(piece))).alias("text"),
        )

    return rendered.withColumn("turns", F.transform(pieces, turn)).withColumn(
        "loss_texts",
        F.transform("loss_spans", lambda s: unescaped(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")))),
    )
