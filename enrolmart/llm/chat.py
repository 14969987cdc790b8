"""Chat formatting with prefix-target expansion.

Every turn becomes a segment ``<|im_start|>role``, line feed, text,
``<|im_end|>``, line feed; a conversation's segments in turn order are its
stream.  Every assistant turn is an example of its own: the stream up to and
including that turn, of which only the reply's text is trainable.
``segments`` keeps places in the stream, ``examples`` writes each prefix out
next to its target.  Written prefixes grow with the square of a
conversation's length: they pass through the task that holds the stream one
by one, and only what is read from them goes on.

Control strings inside texts and roles are escaped by one more backslash
after their first character (``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes
``<\\\\/s>``), which is undone by removing one; so no text can end a turn or
open one.  Line feeds and backslashes of a role are escaped as well.

Turns are ordered by turn, then role, then text; offsets are running sums
within blocks of turns plus the blocks' sums.  Turns of one conversation
whose turn is null, or all equal, are one block, which one task sorts.
``streams`` and ``read_back`` gather a conversation in one row.  Everything is
DataFrame functions.

Defined cases: null texts and roles are empty; a null turn comes first; null
conversation ids are one conversation; repeated rows are turns of their own;
a conversation without assistant turns has no examples and an empty loss; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm.common import col

# Strings that templates give a meaning.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
# Turns of one block of running sums.
BLOCK = 1024


def _quote(text: str) -> str:
    return "".join("\\" + c if c in "|[]" else c for c in text)


_RESTS = "|".join(_quote(c[1:]) for c in CONTROL)
ESCAPE = rf"([<\[])(\\*)({_RESTS})"
UNESCAPE = rf"([<\[])\\(\\*)({_RESTS})"
TURN = rf"(?s){_quote(OPEN)}([^\n]*)\n(.*?){_quote(CLOSE)}\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def escape_role(role: Column) -> Column:
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(one_line)


def unescape_role(role: Column) -> Column:
    """Pairs of backslashes stand for one, a single one before n for a line feed."""
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(
        F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"
    )


def segments(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn: conv_id, turn, role, segment, start and end in its conversation's
    stream, and for assistant turns loss_start and loss_end: an example is the stream's
    [0, end) with the loss mask [loss_start, loss_end)."""
    rows = conversations.select(
        col(conv_col).cast("long").alias("conv_id"),
        col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    # Lengths go along instead of the parts they measure.
    rows = rows.select(
        "*",
        F.concat(head, body, F.lit(CLOSE + "\n")).alias("segment"),
        F.length(head).alias("head_size"),
        F.length(body).alias("body_size"),
        F.floor(F.col("turn") / BLOCK).alias("block"),
    ).withColumn("size", F.length("segment").cast("long"))
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("upto", F.sum("size").over(upto))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
    )
    joined = inside.join(
        blocks,
        F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block")),
    )
    end = F.col("base") + F.col("upto")
    start = end - F.col("size")
    reply = F.col("role") == "assistant"
    loss = start + F.col("head_size")
    return joined.select(
        "conv_id",
        "turn",
        "role",
        "segment",
        start.alias("start"),
        end.alias("end"),
        F.when(reply, loss).alias("loss_start"),
        F.when(reply, loss + F.col("body_size")).alias("loss_end"),
    )


def streams(formatted: DataFrame) -> DataFrame:
    """(conv_id, stream, masks): each conversation written out, with its examples' loss masks."""
    placed = F.sort_array(
        F.collect_list(F.struct("start", "segment", "loss_start", "loss_end"))
    )
    return (
        formatted.groupBy("conv_id")
        .agg(placed.alias("s"))
        .select(
            "conv_id",
            F.array_join(F.col("s.segment"), "").alias("stream"),
            F.filter("s", lambda x: x["loss_start"].isNotNull()).alias("masks"),
        )
    )


def _exploded(written: DataFrame) -> DataFrame:
    one = written.select("conv_id", "stream", F.posexplode("masks").alias("example", "m"))
    first, last = F.col("m.loss_start").cast("int"), F.col("m.loss_end").cast("int")
    return one.select(
        "conv_id",
        "example",
        F.substring(F.col("stream"), F.lit(1), first).alias("context"),
        F.substring(F.col("stream"), first + 1, last - first).alias("target"),
        "m.loss_start",
        "m.loss_end",
    ).withColumn("context_chars", F.length("context").cast("long"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, example, context, target, loss_start, loss_end,
    context_chars.

    The context is the conversation's stream up to the reply, written out, and the target
    the escaped text under the loss mask; both are cut out of the stream.
    """
    return _exploded(streams(formatted))


def expand(formatted: DataFrame) -> DataFrame:
    """(conv_id, example, context, target): the texts of ``examples``."""
    return examples(formatted).select("conv_id", "example", "context", "target")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, stream, turns array<struct<role, text>>, replies array<string>, n_examples,
    context_chars): turns parsed from the written streams, replies and contexts from the
    examples."""
    roles = F.regexp_extract_all("stream", F.lit(TURN), F.lit(1))
    texts = F.regexp_extract_all("stream", F.lit(TURN), F.lit(2))
    turns = F.zip_with(
        roles,
        texts,
        lambda r, t: F.struct(unescape_role(r).alias("role"), unescape(t).alias("text")),
    )
    written = streams(formatted)
    found = _exploded(written)
    # Streams and what their examples tell meet in one grouping by conversation.
    rows = written.select("conv_id", "stream", F.lit(None).alias("example")).union(
        found.select(
            "conv_id",
            F.lit(None),
            F.struct("example", unescape(F.col("target")).alias("reply"), "context_chars"),
        )
    )
    gathered = rows.groupBy("conv_id").agg(
        F.max("stream").alias("stream"),
        F.sort_array(F.collect_list("example")).alias("examples"),
    )
    return gathered.select(
        "conv_id",
        "stream",
        turns.alias("turns"),
        F.col("examples.reply").alias("replies"),
        F.size("examples").cast("long").alias("n_examples"),
        F.aggregate(
            "examples", F.lit(0).cast("long"), lambda n, e: n + e["context_chars"]
        ).alias("context_chars"),
    )


# The conversation that the registered query adds.
EXTRA = tuple((-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant")))
_EXTRA_SQL = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in EXTRA)


def op7(conversations: DataFrame) -> DataFrame:
    extra = conversations.sparkSession.sql(f"SELECT * FROM VALUES {_EXTRA_SQL} AS t(conv_id, turn, role, text)")
    rows = conversations.select(
        col("conv_id").cast("long"), col("turn").cast("long"), "role", "text"
    ).union(extra)
    back = read_back(segments(rows))
    line = F.lit("\n")
    said = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    loss = F.array_join("replies", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("stream").cast("long").alias("formatted_chars"),
        "n_examples",
        "context_chars",
    )


_ESC = f"regexp_replace({{}}, '{ESCAPE}', '\\1\\2\\\\\\3', 'g')"
_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {_EXTRA_SQL})
), f AS (
  SELECT *, {len(OPEN) + len(CLOSE) + 2} + length({_ESC.format(_ROLE)})
            + length({_ESC.format('text')}) AS n,
         {len(OPEN) + 1} + length({_ESC.format(_ROLE)}) AS head
  FROM c
), p AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                         ROWS UNBOUNDED PRECEDING) - n + head AS context
  FROM f
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       coalesce(sum(context) FILTER (role = 'assistant'), 0)::BIGINT AS context_chars
FROM p GROUP BY conv_id
"""
