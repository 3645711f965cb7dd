"""Chat formatting by prefix-target expansion (operator 4).

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is under the loss mask. Turns that follow the
last reply are kept as one more example without a target, so that the output
holds every turn.

Template, with ``role`` and ``text`` escaped: an assistant turn is
``<s>text</s>``, any other turn ``[INST]role\\ntext[/INST]``. A control string
inside a role or text gets one backslash more after its first character
(``[INST]`` becomes ``[\\INST]``, ``[\\INST]`` becomes ``[\\\\INST]``), so no
text can end or begin a turn, and one backslash less gives it back.

Defined cases: a null text or role is empty; a null conversation id is a
conversation like any other; turns are ordered by turn (null first), then by
their formatted text, and repeated rows stay repeated; other columns are
ignored; an empty table gives no examples.

Everything is built-in functions. A conversation's turns meet in one row
because its last example holds them all by definition; examples are written
one row at a time, never as an array of all prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
# The template's control strings.
TURN_OPEN, TURN_CLOSE, REPLY_OPEN, REPLY_CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
CONTROL = r"([\[<])(\\*)(/?(?:INST\]|s>))"
TURN = r"(?s)\[INST\][^\n]*\n.*?\[/INST\]|<s>.*?</s>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\[<])\\(\\*)(/?(?:INST\]|s>))", "$1$2$3")


def escape_role(c: Column) -> Column:
    """Also free of line feeds, since one ends the role."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    parts = F.split(unescape(c), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per example: ``conv_id``, ``example`` (0-based, in turn
    order), ``trainable``, ``is_last`` (the example that holds all turns),
    ``formatted`` and the loss mask as ``mask_start``, ``mask_length`` in code
    points (length 0 in the example without a target)."""
    reply = F.coalesce(F.col("role"), F.lit("")) == ASSISTANT
    text = escape(F.coalesce(F.col("text"), F.lit("")))
    piece = F.when(reply, F.concat(F.lit(REPLY_OPEN), text, F.lit(REPLY_CLOSE))).otherwise(
        F.concat(F.lit(TURN_OPEN), escape_role(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"), text, F.lit(TURN_CLOSE)))
    turns = (conversations.select("conv_id", F.struct("turn", piece.alias("piece"), reply.alias("reply")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    last = F.size("turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("turns", i)["reply"] | (i == last))
    upto = F.transform(F.slice("turns", F.lit(1), F.col("at") + 1), lambda t: t["piece"])
    examples = (turns.select("conv_id", "turns", F.posexplode(targets).alias("example", "at"))
                .select("conv_id", F.col("example").cast("long").alias("example"),
                        F.get("turns", F.col("at"))["reply"].alias("trainable"),
                        (F.col("at") == last).alias("is_last"),
                        F.char_length(F.get("turns", F.col("at"))["piece"]).alias("_piece"),
                        F.array_join(upto, "").alias("formatted")))
    inner = F.col("_piece") - len(REPLY_OPEN) - len(REPLY_CLOSE)
    start = F.char_length("formatted") - len(REPLY_CLOSE) - inner
    return examples.select(
        "conv_id", "example", "trainable", "is_last", "formatted",
        F.when(F.col("trainable"), start).otherwise(F.lit(0)).alias("mask_start"),
        F.when(F.col("trainable"), inner).otherwise(F.lit(0)).alias("mask_length"))


def masked_text(formatted="formatted") -> Column:
    """The text under the loss mask, as it was before escaping."""
    return unescape(F.substring(F.col(formatted), F.col("mask_start") + 1, F.col("mask_length")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: array of (role, text)."""
    pieces = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))

    def turn(p: Column) -> Column:
        reply = F.startswith(p, F.lit(REPLY_OPEN))
        body = F.when(reply, F.substring(p, len(REPLY_OPEN) + 1, F.char_length(p) - len(REPLY_OPEN) - len(REPLY_CLOSE))
                      ).otherwise(F.substring(p, len(TURN_OPEN) + 1, F.char_length(p) - len(TURN_OPEN) - len(TURN_CLOSE)))
        cut = F.locate("\n", body)
        role = F.when(reply, F.lit(ASSISTANT)).otherwise(unescape_role(F.substring(body, F.lit(1), cut - 1)))
        text = F.when(reply, body).otherwise(F.substring(body, cut + 1, F.char_length(body)))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: turns, their
    hash, the text under the loss masks in order, and all characters written.
    The examples of a conversation lie in one partition already."""
    read = examples.select(
        "conv_id", F.char_length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_last"), F.col("formatted")).alias("whole"),
        F.struct("example", masked_text().alias("loss")).alias("loss"))
    per_conv = read.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"), F.max("whole").alias("whole"),
        F.sort_array(F.collect_list("loss")).alias("losses"))
    both = per_conv.select(
        "conv_id", "formatted_chars", read_turns(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return both.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


PLANTED = "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose two turns hold control strings."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
                                F.lit(PLANTED).alias("text"))
    return digest(format_conversations(given.unionByName(own)))


OP4_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?(?:INST\]|s>))', '\1\\\2\3', 'g')) +
    CASE WHEN role = 'assistant' THEN 7
         ELSE 14 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([\[<])(\\*)(/?(?:INST\]|s>))', '\1\\\2\3', 'g')) END AS chars
  FROM given),
placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR is_last)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""
