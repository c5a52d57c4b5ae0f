r"""Chat formatting with a grammar that reads its own output back.

A turn is an opening mark, its text and a closing mark: <<SYS>>..<</SYS>> for the system, [INST]..[/INST] for the
user, <s>..</s> for the assistant, [ROLE]role[TEXT]..[/ROLE] for any other role. A text that holds a mark, or that
does not come back from the parser as it is, is escaped: backslashes are doubled, then one backslash is put into each
mark after its bracket. As doubled runs are even, the single one tells marks in texts from real ones, and reading
takes it out again. The parsed turns of each conversation are compared with the source; on a difference all its turns
are escaped, which needs no second time, as an escaped text holds no mark and each of its own runs is even. A
conversation that still differed would come out with a null text and an error of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import table

#: (role, opening mark, closing mark); other roles have the last two marks and a third between role and text.
MARKS = (("system", "<<SYS>>", "<</SYS>>"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
OTHER, MIDDLE, OTHER_END = "[ROLE]", "[TEXT]", "[/ROLE]"
#: What follows the bracket of a mark.
TAIL = r"(/?(?:INST|ROLE)\]|TEXT\]|/?s>|<SYS>>|</SYS>>)"
BLOCK = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([\[<])" + TAIL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, r"([\[<])\\" + TAIL, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def _block(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(OTHER), escape(role), F.lit(MIDDLE), text, F.lit(OTHER_END))
    for name, begin, end in MARKS:
        out = F.when(role == name, F.concat(F.lit(begin), text, F.lit(end))).otherwise(out)
    return out


def blocks(formatted: Column) -> Column:
    return F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(0))


def _inner(block: Column, begin: str, end: str) -> Column:
    return F.substr(block, F.lit(len(begin) + 1), F.length(block) - (len(begin) + len(end)))


def _turn(block: Column) -> Column:
    """role, text (unescaped) and the place of the text within the block."""
    inner = _inner(block, OTHER, OTHER_END)
    role = F.substring_index(inner, MIDDLE, 1)
    begin = F.length(role) + len(OTHER) + len(MIDDLE)
    out = F.struct(unescape(role).alias("role"), unescape(F.substr(inner, F.length(role) + len(MIDDLE) + 1)).alias("text"), begin.alias("begin"), (F.length(block) - begin - len(OTHER_END)).alias("n"))
    for name, start, end in MARKS:
        known = F.struct(F.lit(name).alias("role"), unescape(_inner(block, start, end)).alias("text"), F.lit(len(start)).alias("begin"), (F.length(block) - (len(start) + len(end))).alias("n"))
        out = F.when(F.startswith(block, F.lit(start)), known).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    return F.transform(blocks(formatted), lambda b: F.struct(_turn(b)["role"].alias("role"), _turn(b)["text"].alias("text")))


def _returns(formatted: Column, turns: Column) -> Column:
    source = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (F.array_join(blocks(formatted), "") == formatted) & (parse(formatted) == source)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, error): a row per conv_id with its text, the spans (begin from 0, n) of the assistant's texts
    and null, or what is wrong.

    Turns go by turn, then role and text, nulls first; repeated rows are turns of their own. Null texts and roles are
    empty strings, an unknown role keeps its name, and each row without conv_id is a conversation of one turn. Other
    columns are ignored; an empty table gives an empty result. A conversation is one value, so its turns meet in one row.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = _block(F.col("role"), F.col("text"))
    clear = ~F.col("text").rlike(r"[\[<]" + TAIL) & (unescape(F.col("text")) == F.col("text"))
    rows = rows.withColumn("safe", _block(F.col("role"), escape(F.col("text")))).withColumn("block", F.when(clear, plain).otherwise(F.col("safe")))
    lone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    chats = rows.groupBy("conv_id", lone.alias("lone")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "block", "safe"))).alias("turns"))
    for name in ("block", "safe"):
        chats = chats.withColumn(name, F.array_join(F.col("turns").getField(name), ""))
    formatted = F.when(_returns(F.col("block"), F.col("turns")), F.col("block")).when(_returns(F.col("safe"), F.col("turns")), F.col("safe"))
    chats = chats.select("conv_id", formatted.alias("formatted")).withColumn("error", F.when(F.col("formatted").isNull(), "does not come back from its own format"))

    places = F.transform(blocks(F.col("formatted")), lambda b: F.struct(_turn(b).alias("t"), F.length(b).alias("length")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,n:int>>").alias("spans"))
    spans = F.aggregate(
        places, empty,
        lambda s, p: F.struct(
            (s["at"] + p["length"]).alias("at"),
            F.when(p["t"]["role"] == "assistant", F.array_append(s["spans"], F.struct((s["at"] + p["t"]["begin"]).alias("begin"), p["t"]["n"].alias("n")))).otherwise(s["spans"]).alias("spans"),
        ),
    )
    return chats.select("conv_id", "formatted", spans["spans"].alias("loss"), "error")


def digests(chats: DataFrame) -> DataFrame:
    """What the contract asks for, read back from format_chats() output."""
    turns = parse(F.col("formatted"))
    said = F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["begin"] + 1, s["n"]))), "")
    read = chats.select("conv_id", "formatted", turns.alias("turns"), said.alias("said"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return digests(format_chats(told.union(extra)))


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, CASE WHEN regexp_matches(text, '[\[<](/?(?:INST|ROLE)\]|TEXT\]|/?s>|<SYS>>|</SYS>>)')
      OR replace(regexp_replace(text, '([\[<])\\(/?(?:INST|ROLE)\]|TEXT\]|/?s>|<SYS>>|</SYS>>)', '\1\2', 'g'), '\\', '\') <> text
    THEN regexp_replace(replace(text, '\', '\\'), '([\[<])(/?(?:INST|ROLE)\]|TEXT\]|/?s>|<SYS>>|</SYS>>)', '\1\\\2', 'g') ELSE text END AS x FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(x) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
