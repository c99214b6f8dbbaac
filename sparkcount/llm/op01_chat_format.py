"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

A log row is an event of one conversation: ``conv_id, seq, turn, role, text,
event``.  Events are

* ``message``     the whole text of a turn (replaces what the turn held),
* ``delta``       text streamed on to the turn,
* ``edit``        a new text for the turn, other turns stay,
* ``regenerate``  the turn starts again, empty, and all later turns go.

Events are ordered by ``(seq, turn, event, role, text)`` in each conversation
and folded: a turn holds what came after its last ``message``, ``edit`` or
``regenerate``, unless a later ``regenerate`` of an earlier turn removed it.

Rendering: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  In a text every
``<`` + k backslashes + ``|`` gets one backslash more, so a rendered text never
holds ``<|``, and taking one away restores it.  Roles are percent-encoded.  The
loss mask is kept by segments: the segments of a row joined are its formatted
string, and the segments with ``loss`` set are exactly the assistant texts.

Defined cases: null text, role and event are empty text, empty role and
``message``; a null seq sorts first; null conversation ids are one
conversation; equal turns keep all their rows when each message opens a turn
(``by_row``), in the order above; an empty log gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _encode_role(role: Column) -> Column:
    for a, b in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def _decode_role(role: Column) -> Column:
    for a, b in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(b), F.lit(a))
    return role


def fold(events: DataFrame, by_row: bool = False) -> DataFrame:
    """Final messages ``(conv_id, turn, ord, sub, role, text)`` of an event log.

    ``by_row``: every ``message`` row opens a turn of its own, so rows that repeat
    a turn number all stay; other events go to the turn of their number that was
    opened last.  ``sub`` counts the turns of one number, ``ord`` is the seq of
    the first event (the turn number without ``by_row``)."""
    ev = events.select(
        "conv_id", "turn", F.struct(
            "seq", "turn", F.coalesce("event", F.lit("message")).alias("event"),
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    # one row per turn with its events in order: aggregated before the shuffle,
    # so that a conversation of any length is spread over the tasks
    turns = ev.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list("e")).alias("p"))
    cut = _cuts(ev)
    same = turns["conv_id"].eqNullSafe(cut["cut_conv"]) & (turns["turn"] == cut["cut_turn"])
    live = turns.join(cut, same, "left").select(
        "conv_id", "turn", F.expr("filter(p, x -> cut is null or x >= cut)").alias("p"))
    opened = ("size(p) > 0" if not by_row else "i = 0 or p[i].event = 'message'")
    first = "sequence(0, size(p) - 1)" if by_row else "array(0)"
    subs = live.where("size(p) > 0").select("conv_id", "turn", "p", F.expr(
        f"filter({first}, i -> {opened})").alias("at")).select("conv_id", "turn", F.posexplode(F.expr(
            "transform(at, (a, k) -> slice(p, a + 1, coalesce(get(at, k + 1), size(p)) - a))")).alias("sub", "p"))
    # what came before the last event that is no delta is replaced
    start = "coalesce(array_max(transform(p, (x, i) -> if(x.event <> 'delta', i, null))), 0)"
    parts = subs.select("conv_id", "turn", "sub", F.expr("p[0].seq").alias("seq"), F.expr(
        f"if(size(p) = 1, p, slice(p, {start} + 1, size(p)))").alias("p"))
    return parts.select(
        "conv_id", "turn", F.col("seq" if by_row else "turn").cast("long").alias("ord"), "sub",
        # the first part that names a role gives the turn's
        F.coalesce(F.expr("get(filter(p, x -> x.role <> ''), 0).role"), F.lit("")).alias("role"),
        F.expr("array_join(transform(p, x -> x.text), '')").alias("text"))


def _cuts(ev: DataFrame) -> DataFrame:
    """``cut_conv, cut_turn, cut``: the last ``regenerate`` of an earlier turn, for
    the turns after one; what a turn holds from before it is gone.  Turns are
    taken in blocks of numbers, so no window spans a long conversation."""
    again = ev.where("e.event = 'regenerate' and turn is not null").groupBy("conv_id", "turn").agg(F.max("e").alias("r"))
    keys = ev.where("turn is not null").select("conv_id", "turn").distinct()
    named = F.struct("conv_id").alias("c")  # null conversations join as equals
    marked = keys.select(named, "turn").join(again.select(named), "c", "left_semi").join(
        again.select(named, "turn", "r"), ["c", "turn"], "left").withColumn(
        "block", F.expr(f"floor(turn / {BLOCK})"))
    blocks = marked.groupBy("c", "block").agg(F.max("r").alias("r"))
    before = blocks.withColumn("wide", F.expr(f"floor(block / {BLOCK})"))
    wides = before.groupBy("c", "wide").agg(F.max("r").alias("r"))

    def earlier(of: str, *within: str):
        return F.max("r").over(Window.partitionBy(*within).orderBy(of).rowsBetween(
            Window.unboundedPreceding, -1))

    wides = wides.select("c", "wide", earlier("wide", "c").alias("w"))
    before = before.select("c", "wide", "block", earlier("block", "c", "wide").alias("b")).join(
        wides, ["c", "wide"]).select("c", "block", F.greatest("b", "w").alias("b"))
    return marked.select("c", "block", "turn", earlier("turn", "c", "block").alias("t")).join(
        before, ["c", "block"]).select(
        F.col("c.conv_id").alias("cut_conv"), F.col("turn").alias("cut_turn"), F.greatest("t", "b").alias("cut")).where(
        "cut is not null")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, segments array<struct<text, loss>>)`` per conversation."""
    m = messages.select("conv_id", F.struct(
        "ord", "turn", "sub", "role", "text").alias("m"))
    grouped = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))

    def turn(x: Column) -> Column:
        head = F.concat(F.lit(OPEN), _encode_role(x["role"]), F.lit("\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(x["text"]).alias("text"),
                                (x["role"] == loss_role).alias("loss")),
                       F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))

    seg = grouped.select("conv_id", F.flatten(F.transform("ms", turn)).alias("segments"))
    return seg.select("conv_id", F.expr(
        "array_join(transform(segments, s -> s.text), '')").alias("formatted"), "segments")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text parsed from rendered rows: ``(conv_id, turns
    array<struct<role, text>>, loss_text, formatted)``."""
    body = F.expr(f"split(formatted, '<\\\\|im_end\\\\|>\\n')")
    parts = F.filter(body, lambda s: F.startswith(s, F.lit(OPEN)))

    def parse(s: Column) -> Column:
        at = F.locate("\n", s)
        role = F.substring(s, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(_decode_role(role).alias("role"),
                        unescape(F.substring(s, at + 1, F.length(s))).alias("text"))

    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
    return formatted.select("conv_id", F.transform(parts, parse).alias("turns"),
                            loss.alias("loss_text"), "formatted")


def summary(read: DataFrame) -> DataFrame:
    """Digest columns of the contract from what was read back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
