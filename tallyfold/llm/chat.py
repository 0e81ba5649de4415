"""Chat formatting: conversations rebuilt from an event log, then rendered with a loss mask.

A log holds events of conversations: (conv_id, slot, seq, kind, role, text). A slot is the
place of a message in its conversation. Sorted by seq, the events of a slot are folded
into one message:

* `open` begins the message and names its role,
* `delta` adds a streamed piece of text,
* `edit` puts its text in place of all text so far,
* `regenerate` takes all text so far back, so that new deltas begin from nothing.

Defined cases: a null text is empty, a null role is the empty role; events that tie on
seq go by kind, role and text; a repeated event counts as often as it occurs; a message
has the role of its last event that names one; a null conversation, slot or seq sorts first and is kept
as its own key; a conversation without events has no row, an empty log gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rendered form. Fixed values of this template: the marks and what escapes them.
TURN_START, TEXT_START, TURN_STOP = "<s>[INST]", "[/INST]", "</s>"
# `&` first: all marks hold `<` or `[`, so an escaped text holds no mark.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
# A streamed text is cut into at most this many deltas, so that cutting stays linear.
MOST_DELTAS = 64
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def streamed(turns: DataFrame, piece: int = 512) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text).

    Every turn is opened, then its text arrives in deltas of `piece` characters, or of
    1/64 of the text if that is more. Repeated rows of a turn become one slot each; rows
    that share a turn are ordered by role and text.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    # All rows of a turn: they are few, and hold the same turn of the same conversation.
    shared = turns.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct(role.alias("role"), text.alias("text")))).alias("rows")
    )
    rows = shared.select("conv_id", "turn", F.posexplode("rows").alias("copy", "row"))
    size = F.greatest(F.lit(piece), F.ceil(F.length("row.text") / MOST_DELTAS)).cast("int")
    starts = F.sequence(F.lit(0), F.ceil(F.length("row.text") / size).cast("int"))
    opened = F.array(F.struct(F.lit(0).alias("seq"), F.lit("open").alias("kind"),
                              F.col("row.role").alias("role"), F.lit("").alias("text")))
    deltas = F.transform(F.slice(starts, 1, F.size(starts) - 1), lambda i: F.struct(
        (i + 1).alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
        F.substring(F.col("row.text"), i * size + 1, size).alias("text")))
    return rows.select(
        "conv_id", F.struct("turn", "copy").alias("slot"), F.inline(F.concat(opened, deltas))
    )


def _folded(events: Column) -> tuple[Column, Column]:
    """Role and text of a message from its sorted events, in one pass each."""
    resets = F.transform(events, lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(-1))
    last = F.greatest(F.array_max(resets), F.lit(0))
    live = F.slice(events, last + 1, F.size(events) - last)
    texts = F.transform(live, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(F.coalesce(e["text"], F.lit(""))))
    roles = F.filter(F.transform(events, lambda e: e["role"]), lambda r: r.isNotNull())
    return F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")), F.array_join(texts, "")


def fold_events(events: DataFrame) -> DataFrame:
    """One row per message: conv_id, slot, role, text.

    Grouped by conversation and slot, so a long conversation is folded by many tasks and
    only its finished messages meet later.
    """
    event = F.struct("seq", "kind", "role", "text")
    slots = events.groupBy("conv_id", "slot").agg(F.array_sort(F.collect_list(event)).alias("events"))
    role, text = _folded(F.col("events"))
    return slots.select("conv_id", "slot", role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments, formatted.

    A turn is `<s>[INST]role[/INST]text</s>`, role and text escaped. `segments` is the
    formatted text cut where the loss mask changes: structs of text and `loss`, which is
    true for the texts of the assistant. `formatted` is their concatenation.

    A conversation becomes one row, so its finished messages meet in one task: that is
    the size of the result row itself.
    """
    turn = F.struct("slot", "role", "text")
    grouped = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def rendered(t: Column) -> Column:
        head = F.concat(F.lit(TURN_START), escape(t["role"]), F.lit(TEXT_START))
        return F.array(segment(head, F.lit(False)),
                       segment(escape(t["text"]), t["role"] == TRAINED_ROLE),
                       segment(F.lit(TURN_STOP), F.lit(False)))

    segments = F.flatten(F.transform("turns", rendered))
    return grouped.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), segments.alias("segments")
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def format_chats(events: DataFrame) -> DataFrame:
    """Event log to formatted conversations."""
    return render(fold_events(events))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, F.lit(TURN_STOP))
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def parsed(turn: Column) -> Column:
        body = F.substring(turn, len(TURN_START) + 1, 2**31 - 1)
        halves = F.split(body, r"\[/INST\]")
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(turns, parsed)


def read_loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    masked = F.filter(segments, lambda s: s["loss"])
    return unescape(F.array_join(F.transform(masked, lambda s: s["text"]), ""))
