"""Chat formatting: event-sourced reconstruction of conversations, then rendering.

The input is a log of events (conv_id, seq, turn, event, role, text):

* ``open`` starts a message and names its role;
* ``delta`` adds text to it;
* ``edit`` replaces all text so far by its own;
* ``regenerate`` throws away all text so far; the deltas that follow make the new answer.

A message's final text is that of its last ``edit`` or nothing after its last ``regenerate``,
followed by the deltas after that event, in the order of ``seq``.  Messages are folded by
(conversation, message) first, so a conversation that holds a third of all rows is spread over many
tasks; only finished, rendered messages meet, as they must, in the one row of their conversation.

Rendering: each message becomes ``<turn>### Role: text</turn>`` and a line feed.  In roles and texts
the escape character is doubled and ``<`` (which opens every mark) and, in roles, ``:`` get codes of
their own, so no text can look like a mark, and unescaping gives it back exactly.  The loss mask
holds for each message the place and length of the text to learn from (assistant messages only), in
code points from the start of its rendering.

All of it is DataFrame functions.  Defined cases: null text or role counts as empty; messages tied
on turn are ordered by role, then text, repeated rows stay repeated; an empty log gives no
conversations; null conv_id or turn are a conversation and a turn of their own, first in order;
extra columns, whatever their names, are ignored; messages of any length are rendered whole, a
conversation into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

OPEN, HEAD, TAIL = "<turn>### ", ": ", "</turn>\n"
LEARN = "assistant"


def escaped(col, role: bool = False):
    col = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))
    return F.replace(col, F.lit(":"), F.lit("\\c")) if role else col


def unescaped(col):
    # Between doubled escapes, each single one starts a code.
    parts = F.transform(F.split(col, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")),
                                                                  F.lit("\\c"), F.lit(":")))
    return F.array_join(parts, "\\")


def fold(log: DataFrame) -> DataFrame:
    """Events -> one row per message: conv_id, turn, message, role, text."""
    key = ["conv_id", "turn", "message"]
    start = F.when(F.col("event").isin("edit", "regenerate"), F.col("seq"))
    # Deltas before the last edit or regeneration are void: they go before anything is gathered.
    last = F.max(start).over(Window.partitionBy(*key))
    live = log.withColumn("from", last).filter(
        (F.col("event") == "open") | F.col("from").isNull() | (F.col("seq") >= F.col("from")))
    piece = F.when(F.col("event").isin("delta", "edit"), F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))
    return live.groupBy(*key).agg(
        F.max(F.when(F.col("event") == "open", F.coalesce("role", F.lit("")))).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Messages -> one row per conversation: conv_id, formatted, mask (array of place, size)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escaped(role, True), F.lit(HEAD))
    body = escaped(text)
    one = messages.select(
        "conv_id",
        F.struct("turn", "message", F.concat(head, body, F.lit(TAIL)).alias("line"),
                 F.when(role == LEARN, F.struct((F.length(head) + 1).alias("place"), F.length(body).alias("size")))
                 .otherwise(F.struct(F.lit(0).alias("place"), F.lit(0).alias("size"))).alias("mask")).alias("m"))
    whole = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    return whole.select("conv_id", F.array_join(F.transform("m", lambda m: m["line"]), "").alias("formatted"),
                        F.transform("m", lambda m: m["mask"]).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Rendered conversations -> conv_id, turns (array of role, text), learned (array of texts)."""
    lines = F.filter(F.split("formatted", TAIL), lambda x: x != "")
    turn = F.transform("lines", lambda x: F.struct(
        unescaped(F.substr(F.substring_index(x, HEAD, 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescaped(F.substr(x, F.length(F.substring_index(x, HEAD, 1)) + len(HEAD) + 1)).alias("text")))
    learned = F.transform(F.filter(F.zip_with("lines", "mask", lambda x, m: F.when(m["place"] > 0, F.substr(x, m["place"], m["size"]))),
                                   lambda x: x.isNotNull()), unescaped)
    return (formatted.withColumn("lines", lines)
            .select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), turn.alias("turns"), learned.alias("learned")))


def event_log(messages: DataFrame) -> DataFrame:
    """The log that a chat service would have kept for finished messages (conv_id, turn, role, text).

    Users' texts come as a draft (their first half) that an edit replaces; all others are streamed in
    two deltas, and an assistant's first answer is thrown away and streamed again.
    """
    tied = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    m = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                        F.row_number().over(tied).alias("message"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    first, second = F.substr("text", F.lit(1), half), F.substr("text", half + 1, n)

    def event(seq, kind, text):
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("event"), text.alias("text"))

    none = F.lit(None).cast("string")
    events = (F.when(F.col("role") == "user", F.array(event(0, "open", none), event(1, "delta", first), event(2, "edit", F.col("text"))))
              .when(F.col("role") == LEARN, F.array(event(0, "open", none), event(1, "delta", second), event(2, "regenerate", none),
                                                    event(3, "delta", first), event(4, "delta", second)))
              .otherwise(F.array(event(0, "open", none), event(1, "delta", first), event(2, "delta", second))))
    return m.select("conv_id", "turn", "message", "role", F.inline(events))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(tricky).alias("text"))
    back = read_back(render(fold(event_log(given.unionByName(extra)))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
               .cast("binary"), 256).alias("turns_sha256"),
        F.length(F.array_join("learned", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("learned", "").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(20 + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), ':', '\c'))
              + length(replace(replace(text, '\', '\\'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
