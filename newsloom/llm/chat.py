"""Chat formatting by event-sourced reconstruction (operator 4).

A log has events of conversations in a sequence. A message's events fold into its final text:
`delta` appends its text, `edit` replaces the text so far, `regenerate` clears it; the last role given
counts. So a message is what its events say from its last `edit` or
`regenerate` on, and only those are gathered. Messages are rendered one by one; a running sum
over the conversation gives each its place, and a conversation's text is their concatenation.

Template: `<turn>role\\n` text `</turn>\\n`. In roles and texts a backslash is written `\\b` and `<`
`\\l`, in roles a line feed `\\n`; so no text can contain a mark, and `unescape` gives the text back.
The loss mask lists spans (turn, start, n_chars) of code points that hold assistants' texts.

Cases: messages of any length are kept whole; a null text or role is empty; an unknown kind of event counts as `delta`; events with equal
sequence numbers go by kind, then text; a null conversation id is a conversation of its own; a
message without events does not exist; an empty log gives no rows; further columns are ignored.
A conversation's rendered text is one value of one row, so it does meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.registry import query, table

OPEN, CLOSE = "<turn>", "</turn>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of a log of (conv_id, message, seq, kind, role, text)."""
    resets = F.col("kind").isin("edit", "regenerate")
    in_message = Window.partitionBy("conv_id", "message")
    order = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    said = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    said_by = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("order"))).over(in_message)
    marked = events.withColumn("order", order).select(
        "conv_id", "message", "order", "kind", "text", said_by.alias("role"), F.max(F.when(resets, F.col("order"))).over(in_message).alias("last_reset")
    )
    live = marked.where(F.col("last_reset").isNull() | (F.col("order") >= F.col("last_reset")))
    parts = F.sort_array(F.collect_list(F.struct("order", said.alias("said"))))
    return live.groupBy("conv_id", "message").agg(
        F.coalesce(F.max("role"), F.lit("")).alias("role"),
        F.concat_ws("", F.transform(parts, lambda x: x["said"])).alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, turn_starts, loss_spans) of (conv_id, message, role, text)."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    pieces = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body")).withColumn(
        "piece", F.concat("head", "body", F.lit(CLOSE))
    )
    so_far = Window.partitionBy("conv_id").orderBy("message")
    placed = pieces.withColumn("turn", F.row_number().over(so_far) - 1).withColumn("start", F.sum(F.length("piece")).over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("piece"))
    span = F.struct("turn", (F.col("start") + F.length("head")).alias("start"), F.length("body").cast("long").alias("n_chars"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "start", "piece", F.when(F.col("role") == LEARNED_ROLE, span).alias("span"))))
    return (
        placed.groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select(
            "conv_id",
            F.concat_ws("", F.col("turns.piece")).alias("formatted"),
            F.col("turns.start").alias("turn_starts"),
            F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """`formatted` with `messages` (role, text, ...) and `loss_texts`, from text and mask alone."""
    pieces = F.filter(F.split("formatted", CLOSE), lambda p: p != "")
    apart = formatted.withColumn("pieces", pieces)
    opened = F.transform(
        "pieces",
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text"),
        ),
    )
    at = lambda s: F.get("pieces", s["turn"])
    lost = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr(at(s), (s["start"] - F.get("turn_starts", s["turn"]) + 1).cast("int"), s["n_chars"].cast("int"))),
    )
    return apart.select("*", opened.alias("messages"), lost.alias("loss_texts")).drop("pieces")


def message_log(turns: DataFrame) -> DataFrame:
    """Rows by turn as a log: each row is a message of one event, in order of turn, role and text."""
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(by_turn).alias("message"), F.lit(0).alias("seq"), F.lit("delta").alias("kind"), "role", "text"
    )


PLANTED = "\\### Assistant: </turn> ok"

OP4_SQL = r"""
WITH rows_by_turn AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l')) + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n')) + 15 AS width
  FROM rows_by_turn)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(width)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op4_format_chats", OP4_SQL)
def op4_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE).alias("role"), F.lit(PLANTED).alias("text")
    )
    back = read_back(format_chats(message_log(turns.unionByName(own))))
    digest = F.concat_ws("", F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))))
    loss = F.concat_ws("", "loss_texts")
    return back.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
