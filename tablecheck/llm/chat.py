"""Chat formatting: conversations rebuilt from an event log, then rendered.

A log row is one event of a conversation: ``conv, seq, kind, message, role, text``.

- ``open``: message number ``message`` starts, by ``role``, with ``text`` (may be empty).
- ``delta``: ``text`` is appended to the message.
- ``edit``: ``text`` replaces what the message says so far.
- ``regenerate``: the message starts over with ``text``, and messages numbered after it that
  were written before this event are gone.

``fold_events`` folds the log into final messages, ``render`` writes each conversation as
one text, and ``read_back`` parses such texts again. DataFrame functions only; the one
shuffle is by conversation, and windows keep no more than a running value, so a long
conversation streams through its task up to the point where it becomes one text.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` for every message. Inside texts and
roles ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|``; line ends in roles are
written ``&#10;``. So no text can hold a control string, and reading back gives it unchanged.

Defined cases: a null text or role counts as empty, a null conversation id is a conversation
of its own, a message never opened takes the role of its first event, events with the same
``seq`` follow the order of (message, kind, role, text), repeated events count each time,
an empty log gives no conversation. Other columns of the log are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

START, END = "<|im_start|>", "<|im_end|>\n"
#: Code points of a streamed piece.
PIECE = 200


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def events_of_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Finished turns as the log of how they could have come about.

    Every message is streamed in pieces of ``PIECE`` code points. Every third one is begun with
    another text and edited first. Every fifth is begun with another text, answered, and then
    regenerated, which takes the answer back. Folded, the log gives the turns again.
    """
    picked = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv").orderBy("turn", "role", "text")
    numbered = picked.repartition("conv").withColumn("message", F.row_number().over(order).cast("long"))
    own, said, draft = F.col("message"), F.col("role"), F.reverse("text")

    def event(kind: str, text: Column, message: Column = own, role: Column = said) -> Column:
        return F.struct(F.lit(kind).alias("kind"), message.alias("message"), role.alias("role"), text.alias("text"))

    last = F.greatest(F.ceil(F.char_length("text") / F.lit(PIECE)).cast("int") - 1, F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("text"), i * PIECE + 1, F.lit(PIECE)))
    first = F.col("pieces")[0]
    begun = (
        F.when(own % 5 == 0, F.array(
            event("open", draft), event("open", draft, own + 1, F.lit("assistant")), event("regenerate", first)))
        .when(own % 3 == 0, F.array(event("open", draft), event("delta", draft), event("edit", first)))
        .otherwise(F.array(event("open", first)))
    )
    streamed = F.transform(F.slice("pieces", 2, F.size("pieces")), lambda piece: event("delta", piece))
    events = numbered.withColumn("pieces", pieces).select(
        "conv", own.alias("turn"), F.posexplode(F.concat(begun, streamed)).alias("step", "e")
    )
    return events.select("conv", (F.col("turn") * F.lit(1 << 32) + F.col("step")).alias("seq"), "e.kind", "e.message", "e.role", "e.text")


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages ``conv, message, role, text`` of an event log.

    An event counts unless a later one undoes it: an edit or regeneration of the same
    message, or a regeneration of an earlier message. What is left of a message is its last
    start and the deltas after it.
    """
    events = log.select(
        "conv", F.col("seq").cast("long").alias("seq"), F.col("kind").cast("string").alias("kind"),
        F.col("message").cast("long").alias("message"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition("conv")
    newest_first = [F.desc("seq"), F.desc("message"), F.desc("kind"), F.desc("role"), F.desc("text")]
    later = W.partitionBy("conv").orderBy(*newest_first).rowsBetween(W.unboundedPreceding, -1)
    own = W.partitionBy("conv", "message").orderBy(*newest_first).rowsBetween(W.unboundedPreceding, -1)
    restarts = F.col("kind").isin("edit", "regenerate")
    standing = (
        events.withColumn("cut", F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later))
        .where(F.col("cut").isNull() | (F.col("message") <= F.col("cut")))
        .withColumn("restarted", F.coalesce(F.max(restarts).over(own), F.lit(False)))
    )
    part = F.struct("seq", "kind", "role", "text")
    folded = standing.groupBy("conv", "message").agg(
        F.coalesce(
            F.min(F.when(F.col("kind") == "open", F.struct("seq", "role"))), F.min(F.struct("seq", "role"))
        )["role"].alias("role"),
        F.sort_array(F.collect_list(F.when(~F.col("restarted"), part))).alias("parts"),
    )
    return folded.select(
        "conv", "message", "role", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv, formatted, segments``: one text a conversation, messages in order.

    ``segments`` cuts ``formatted`` into stretches ``text, loss``; the loss mask covers what
    assistants say and nothing of the template.
    """
    turns = F.sort_array(F.collect_list(F.struct("message", "role", "text")))
    grouped = messages.groupBy("conv").agg(turns.alias("turns"))

    def stretches(turn: Column) -> Column:
        opening = F.concat(F.lit(START), _escaped_role(turn["role"]), F.lit("\n"))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"]).alias("text"), (turn["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    cut = grouped.select("conv", F.flatten(F.transform("turns", stretches)).alias("segments"))
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return cut.select("conv", whole.alias("formatted"), "segments")


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv, formatted, turns, loss``: roles and texts parsed from ``formatted``, and the
    unescaped texts under the loss mask."""
    pieces = F.filter(F.split("formatted", "<\\|im_end\\|>\\n"), lambda p: p != "")

    def parsed(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.char_length(piece))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.char_length(role) + 2, F.char_length(body))
        return F.struct(_unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    spoken = F.filter("segments", lambda s: s["loss"])
    return rendered.select(
        "conv", "formatted", F.transform(pieces, parsed).alias("turns"),
        F.transform(spoken, lambda s: unescaped(s["text"])).alias("loss"),
    )
