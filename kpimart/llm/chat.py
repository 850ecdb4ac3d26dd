"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events. Partitioned by conversation and sorted by
``seq``, they fold into final messages, which are rendered with a template:

* ``message`` opens the next message (numbered from 0) with its role and text;
* ``delta`` appends its text to the ``target`` message, or to the last one opened;
* ``edit`` replaces the text of its target by its own;
* ``regenerate`` drops what its target said; the deltas after it say it anew.

The template writes ``<turn ROLE>TEXT</turn>`` and a line end for each message.
In texts and roles ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l`` (in roles
also ``>`` becomes ``\\g``), so no control string can occur in them and
reading back is exact.

Edge cases: null texts and roles are empty; a null conversation id is a
conversation; equal ``seq`` are ordered by kind, role and text; repeated
``message`` events are further messages; events without a message to apply to
are left out; an empty log gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import let, table

OPEN, CLOSE = "<turn ", "</turn>\n"
EVENTS = "conv_id long, seq long, kind string, target long, role string, text string"


def escape(text: Column, head: bool = False) -> Column:
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(">"), F.lit("\\g")) if head else out


def unescape(text: Column) -> Column:
    """A doubled backslash is one; a single one starts a mark. Leftmost first, as they were written."""
    def marks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), marks), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, number, role and final text of every message."""
    log = Window.partitionBy("conv_id").orderBy("seq", "kind", "role", "text")
    opens = F.col("kind") == "message"
    placed = events.select(*[F.col(c.split()[0]) for c in EVENTS.split(", ")]).select(
        "conv_id", "kind", "role", F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(log).alias("pos"),
        (F.sum(opens.cast("int")).over(log.rowsBetween(Window.unboundedPreceding, 0)) - 1).alias("last"), "target")
    placed = placed.withColumn("number", F.when(opens, F.col("last")).otherwise(F.coalesce("target", "last")))
    message = Window.partitionBy("conv_id", "number")
    since = F.max(F.when(F.col("kind") != "delta", F.col("pos"))).over(message)
    opened = F.max(F.when(opens, F.col("pos"))).over(message)
    live = placed.withColumns({"since": since, "opened": opened}).filter(
        (opens | (F.col("pos") > F.col("opened"))) & F.col("opened").isNotNull())
    said = F.transform(F.array_sort(F.collect_list(F.when(F.col("pos") >= F.col("since"), F.struct("pos", "text")))),
                       lambda e: e["text"])
    return live.groupBy("conv_id", "number").agg(F.max(F.when(opens, F.col("role"))).alias("role"),
                                                 F.array_join(said, "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted text and the loss mask: start (from 0) and length of each text to learn."""
    order = Window.partitionBy("conv_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = messages.select("conv_id", "number", "role", F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit(">")).alias("head"),
                            escape(F.col("text")).alias("body"))
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    before = F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0))
    span = F.when(F.col("role") == loss_role, F.struct((before + F.length("head")).cast("long").alias("start"),
                                                       F.length("body").cast("long").alias("length")))
    turns = parts.select("conv_id", "number", "piece", span.alias("span")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("number", "piece", "span"))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role and text) and the unescaped text under the loss mask, from the rendered text."""
    def turn(part: Column) -> Column:
        at = F.instr(part, F.lit(">"))
        return F.struct(unescape(F.substr(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
                        unescape(F.substr(part, at + 1)).alias("text"))

    pieces = F.split("formatted", CLOSE, -1)
    turns = let(pieces, lambda p: F.transform(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), turn))
    masked = F.transform("loss_mask", lambda s: unescape(
        F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The table's rows as a log: answers open empty and their text arrives as a delta."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(order).cast("long"))
    whole = F.struct((F.col("n") * 2).alias("seq"), F.lit("message").alias("kind"), "text")
    begun = F.struct((F.col("n") * 2).alias("seq"), F.lit("message").alias("kind"), F.lit("").alias("text"))
    delta = F.struct((F.col("n") * 2 + 1).alias("seq"), F.lit("delta").alias("kind"), "text")
    events = F.when(F.col("role") == "assistant", F.array(begun, delta)).otherwise(F.array(whole))
    return rows.select("conv_id", "role", F.explode(events).alias("e")).select(
        "conv_id", "e.seq", "e.kind", F.lit(None).cast("long").alias("target"), "role", "e.text")


PROBE = "\\### Assistant: </turn> ok"  # fixed value: both texts of conversation -7


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = read_back(render(fold_events(conversation_events(rows))))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(all_turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP7_SQL = r"""
WITH all_rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
joined AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
           sum(length('<turn >' || role || text || '</turn>') + 1
               + length(role || text) * 2 - length(replace(replace(role || text, '\', ''), '<', ''))
               - length(role || text)
               + length(role) - length(replace(role, '>', ''))) AS formatted_chars
    FROM all_rows GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
