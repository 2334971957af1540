"""Chat formatting (native): conversations rebuilt from an event log, then rendered.

Events of a conversation, by sequence number:

``message``     begins a message; its text is the event's
``delta``       appends to the message
``edit``        replaces all that the message held so far
``regenerate``  replaces it likewise and drops the messages that had begun after this one

Everything is DataFrame functions: windows over one conversation find the last replacement of
each message and the messages that a later regeneration dropped, an aggregate joins the rest.
Rows are exchanged by conversation once; all windows and aggregates keep that partitioning.

Template: ``### {role}\\n{text}</turn>\\n`` for each message.  In roles and texts a backslash is
doubled, then ``</turn>`` becomes ``<\\/turn>`` and ``###`` + space ``#\\## ``; a role's line break
becomes ``\\n``.  Escaped text has no control string, and an escape's backslash stands alone in
its run where a text's own come in pairs, so ``unescape`` gives the text back exactly.

Defined cases: null text or role: empty.  Null event kind: ``message``.  Null message id: the event
is a message of its own.  Events of a message that never began: the first begins it.  Ties
in the sequence number: by kind (message, delta, edit, regenerate), role, text.  Null sequence
number: before all others.  Repeated events count again.  Null conversation id: one conversation
of its own.  Extra columns are ignored.  A conversation is one row, as its text is one value;
that row is the bound on its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"


def escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(c, F.lit("### "), F.lit("#\\## "))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("#\\## "), F.lit("### "))
    c = F.replace(c, F.lit("<\\/turn>"), F.lit("</turn>"))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    """``\\n`` with a lone backslash is a line break; pairs are set aside first."""
    c = F.replace(c, F.lit("\\\\"), F.lit("\\\n"))
    c = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n\n")), F.lit("\\\n"), F.lit("\\\\"))
    return unescape(F.replace(c, F.lit("\n\n"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, place, role, text) of the log (conv_id, seq, kind, message_id, role, text).

    ``place`` orders a conversation's messages; it is 1 for the first.
    """
    kind = F.coalesce(F.lower("kind"), F.lit("message"))
    rank = F.when(kind == "message", 0).when(kind == "delta", 1).when(kind == "edit", 2).otherwise(3)
    log = events.select("conv_id", "seq", rank.alias("rank"), F.col("message_id").cast("string").alias("message_id"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = Window.partitionBy("conv_id")
    order = ["seq", "rank", "role", "text"]
    log = log.withColumn("n", F.row_number().over(conv.orderBy(*order)))
    # a message without an id is known by its event's number; the two kinds of id can't meet
    own = F.when(F.col("message_id").isNull(), F.concat(F.lit("#"), "n")).otherwise(F.concat(F.lit("="), "message_id"))
    log = log.withColumn("message", own)
    message = Window.partitionBy("conv_id", "message")
    log = log.withColumns({
        "born": F.min("n").over(message),
        "reset": F.max(F.when(F.col("rank") != 1, F.col("n"))).over(message),
    })
    # the smallest birth among messages that are regenerated after this event
    later = conv.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log = log.withColumn("again", F.min(F.when(F.col("rank") == 3, F.col("born"))).over(later))
    first = F.col("n") == F.col("born")
    return (log.groupBy("conv_id", "message")
            .agg(F.min("born").alias("place"),
                 F.max(F.when(first, F.col("role"))).alias("role"),
                 F.max(F.when(first, F.col("again"))).alias("again"),
                 F.sort_array(F.collect_list(F.when(
                     F.col("n") >= F.coalesce("reset", "born"), F.struct("n", "text")))).alias("parts"))
            .where(F.col("again").isNull() | (F.col("again") >= F.col("place")))
            .select("conv_id", "place", "role", F.array_join(F.col("parts.text"), "").alias("text")))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans (code points, end exclusive), n_messages.

    A loss span covers the escaped text of a message by one of ``loss_roles``, without its marks.
    """
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = messages.select("conv_id", "place", head.alias("head"), body.alias("body"),
                           F.coalesce(F.col("role"), F.lit("")).isin(*loss_roles).alias("loss"))
    rows = rows.withColumn("size", F.length("head") + F.length("body") + len(CLOSE))
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("stop", F.sum("size").over(so_far) - len(CLOSE))
    span = F.struct((F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("end"))
    return (rows.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("turn")))).alias("turns"),
                 F.sort_array(F.collect_list(F.when(F.col("loss"), span))).alias("loss_spans"),
                 F.count("*").alias("n_messages"))
            .select("conv_id", F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans", "n_messages"))


def format_chats(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Event log to rendered conversations; see ``fold_events`` and ``render``."""
    return render(fold_events(events), loss_roles)


def read_turns(formatted: DataFrame) -> DataFrame:
    """Rendered rows (conv_id, formatted, loss_spans) read back: one row a turn (conv_id, at, role, text, loss,
    formatted_chars).

    A turn is under the loss mask if a loss span ends where its body ends.  The spans' ends are rows
    beside the turns, so that no turn carries its conversation's spans.
    """
    pieces = F.split("formatted", CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last mark
    head = len(OPEN) + 1

    def row(at, role, text, size, stop):
        return F.struct(at.cast("int").alias("at"), role.cast("string").alias("role"), text.cast("string").alias("text"),
                        size.cast("long").alias("size"), stop.cast("long").alias("stop"))

    none = F.lit(None)
    turns = F.transform(pieces, lambda p, i: row(
        i, _unescape_role(F.substring_index(F.substr(p, F.lit(head)), "\n", 1)), unescape(F.substr(p, F.locate("\n", p) + 1)), F.length(p), none))
    ends = F.transform("loss_spans", lambda s: row(none, none, none, F.lit(0), s["end"]))
    rows = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), F.explode(F.concat(turns, ends)).alias("r"))
    rows = rows.select("conv_id", "formatted_chars", "r.*")
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.coalesce(F.sum(F.when(F.col("at").isNotNull(), F.col("size") + len(CLOSE))).over(so_far), F.lit(0))
    rows = rows.withColumn("stop", F.coalesce("stop", before - len(CLOSE)))
    here = Window.partitionBy("conv_id", "stop")
    rows = rows.withColumn("loss", F.max(F.col("at").isNull()).over(here)).where("at IS NOT NULL")
    return rows.select("conv_id", "at", "role", "text", "loss", "formatted_chars")
