"""Chat formatting: event logs folded into messages, rendered with a loss mask, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import only

#: The marks of the template, in the order in which a turn has them.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Where a control string begins, of this template or of the common ones with angles and brackets.
_CONTROLS = r"<(?=\||/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    """Text in which no control string is left: a backslash breaks each, and backslashes are doubled."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROLS, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def folded(events: DataFrame) -> DataFrame:
    """One row (conv_id, seq, role, text) per message of an event log.

    Events are (conv_id, message, seq, kind, role, text). In the order of seq, a ``message`` or an
    ``edit`` sets the text, a ``regenerate`` empties it, a ``delta`` adds to it; so what counts is the
    last event that is no delta and the deltas after it. Null texts are empty, other kinds are
    ignored, equal seq go by kind and text. A message's place is its first seq, its role the first
    one given. A message without events has no row.
    """
    known = F.col("kind").isin("message", "edit", "regenerate", "delta")
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    lists = (
        events.filter(known)
        .groupBy("conv_id", "message")
        .agg(
            F.sort_array(F.collect_list(event)).alias("events"),
            F.min("seq").alias("seq"),
            F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("first"),
        )
    )
    sets = F.transform("events", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(F.lit(0)))
    counts = F.expr("slice(events, greatest(_set, 1), size(events))")
    pieces = F.transform(counts, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"]))
    return lists.withColumn("_set", F.array_max(sets)).select(
        "conv_id", "seq", F.col("first.role").alias("role"), F.array_join(pieces, "").alias("text")
    )


def rendered(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row (conv_id, formatted, turns) per conversation of (conv_id, seq, role, text).

    Turns stand in the order of seq, then role and text. ``formatted`` is the training text.
    ``turns`` gives for each turn where it starts and how long it is, and the part of it that the
    loss covers: the text of a turn whose role is ``learned``; else that part is empty. All in
    code points. A null role or text is empty; turns without a conv_id form one conversation.
    """
    role, text = (escaped(F.coalesce(c, F.lit(""))) for c in ("role", "text"))
    head = F.concat(F.lit(TURN), role, F.lit(TEXT))
    turns = turns.select(
        "conv_id",
        F.struct("seq", "role", "text").alias("place"),
        F.concat(head, text, F.lit(END)).alias("turn"),
        F.length(head).alias("head"),
        F.when(F.col("role") == learned, F.length(text)).otherwise(F.lit(0)).alias("loss_length"),
    )
    order = Window.partitionBy("conv_id").orderBy("place")
    ahead = F.sum(F.length("turn").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.select(
        "conv_id",
        "turn",
        F.row_number().over(order).alias("number"),
        F.coalesce(ahead, F.lit(0)).alias("start"),
        "head",
        "loss_length",
    )
    span = F.struct(
        "number",
        "turn",
        "start",
        F.length("turn").alias("length"),
        (F.col("start") + F.col("head")).alias("loss_start"),
        "loss_length",
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(span)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join("turns.turn", "").alias("formatted"),
        F.transform("turns", lambda t: t.dropFields("number", "turn")).alias("turns"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns of role and text, loss) as the formatted text and its mask say.

    Turns are found by their marks alone; the mask's spans are cut out of them without looking at
    roles.
    """
    quoted = {m: m.replace("|", r"\|") for m in (TURN, TEXT, END)}
    # What stands ahead of the first mark is no turn.
    raw = F.slice(F.split("formatted", quoted[TURN]), 2, 2**31 - 1)
    parts = F.transform("raw", lambda t: F.split(t, f"{quoted[TEXT]}|{quoted[END]}"))
    turns = F.transform(parts, lambda p: F.struct(unescaped(p[0]).alias("role"), unescaped(p[1]).alias("text")))
    cut = F.zip_with(
        "raw",
        "turns",
        lambda t, s: F.substring(t, (s["loss_start"] - s["start"] - len(TURN) + 1).cast("int"), s["loss_length"]),
    )
    return formatted.withColumn("raw", raw).select(
        "conv_id",
        "formatted",
        turns.alias("turns"),
        F.array_join(F.transform(cut, unescaped), "").alias("loss"),
    )


def events_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished turns as an event log: each row is a message of its own, placed by its turn."""
    return only(
        conversations,
        conv_id=conv_id,
        message=F.monotonically_increasing_id(),
        seq=F.col(f"`{turn}`").cast("long"),
        kind=F.lit("message"),
        role=role,
        text=text,
    )


#: Pieces in which a text is streamed, and places between two turns for the events of one.
_PIECES, _STEPS = 4, 16


def event_log(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished turns as the event log that a chat service would have written for them.

    By a hash of its conversation and turn, a turn was streamed (a start and deltas), edited (a draft, then the
    text), regenerated (a draft streamed, thrown away, and the text streamed) or sent as it is; a turn
    without a number was sent. So the text stands nowhere as a whole, but for what was edited or sent, and
    ``folded`` has to work it out. Deltas are cut by code points. A null text is an empty one. Turns lie within
    2 ** 58 of zero. Rows that are repeated are messages of their own.
    """
    rows = only(
        conversations,
        conv_id=conv_id,
        message=F.monotonically_increasing_id(),
        place=F.col(f"`{turn}`").cast("long") * _STEPS,
        role=role,
        text=F.coalesce(F.col(f"`{text}`"), F.lit("")),
        way=F.when(F.col(f"`{turn}`").isNull(), 3).otherwise(F.pmod(F.xxhash64(f"`{conv_id}`", f"`{turn}`"), F.lit(4))),
    )
    draft = F.concat(F.lit("draft of: "), F.reverse("text"))

    def event(step: int, kind: str, said: Column, by: Column = F.lit(None)) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), said.alias("said"), by.cast("string").alias("by"))

    def streamed(said: Column, first: int) -> list[Column]:
        size = F.greatest(F.lit(1), F.ceil(F.length(said) / _PIECES)).cast("int")
        return [event(first + i, "delta", F.substring(said, size * i + 1, size)) for i in range(_PIECES)]

    speaker, empty = F.col("role"), F.lit("")
    ways = [
        [event(0, "message", empty, speaker), *streamed(F.col("text"), 1)],
        [event(0, "message", draft, speaker), event(1, "edit", F.col("text"))],
        [event(0, "message", empty, speaker), *streamed(draft, 1), event(5, "regenerate", empty), *streamed(F.col("text"), 6)],
        [event(0, "message", F.col("text"), speaker)],
    ]
    events = F.when(F.col("way") == 0, F.array(*ways[0]))
    for number, way in enumerate(ways[1:], start=1):
        events = events.when(F.col("way") == number, F.array(*way))
    spread = rows.select("conv_id", "message", "place", F.explode(events).alias("e"))
    return spread.select(
        "conv_id",
        "message",
        (F.col("place") + F.col("e.step")).alias("seq"),
        F.col("e.kind").alias("kind"),
        F.col("e.by").alias("role"),
        F.col("e.said").alias("text"),
    )
