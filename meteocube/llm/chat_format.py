r"""Chat formatting with Spark expressions alone.

The turns of a conversation are collected as structs, sorted, adjacent turns of one role merged into a block by an array
aggregation, and the blocks concatenated:

    <|im_start|>role\ntext<|im_end|>\n                    one turn
    <|im_start|>role\ntext<|sep|>text<|im_end|>\n          merged turns of one role

Inside roles and texts every control string (``CONTROL``) is broken by ``~1`` after its first character, ``~``
itself becomes ``~0``, and a line break of a role ``~2``, so the output is parsed by its markers alone and gives back
every turn. The loss mask is a list of (block, start, length) in characters, start counted in the block: the
texts of the trained role without markers.

Defined results: a null text is an empty text, a null role an empty role; turns are sorted by (turn, role, text), nulls
first; rows that repeat are turns; a null conv_id is one conversation; an empty table gives no conversations; a conversation
without assistant turns has an empty mask; only the four columns are read. A conversation is one output row, so
its group is as large as its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteocube.llm.common import table

START, END, SEP = "<|im_start|>", "<|im_end|>", "<|sep|>"
#: Strings that a text must not spell: this template's, and the control strings of other common templates.
CONTROL = (START, END, SEP, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"
_PATTERN = r"<(?=\|(?:im_start|im_end|sep|endoftext)\|>|/?s>|</?SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("~"), F.lit("~0")), _PATTERN, "$0~1")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("~2"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("~2"), F.lit("\n")))


def _runs(turns: Column) -> Column:
    """Blocks (role, texts) of sorted turns: adjacent turns of one role, found by comparing neighbours, then cut out.

    Linear in the number of turns, where growing an array turn by turn is not.
    """
    n = F.size(turns)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(turns, i - 1)["role"] != F.get(turns, i)["role"]))
    bounds = F.concat(starts, F.array(n))
    return F.transform(
        F.sequence(F.lit(0), F.size(starts) - 1),
        lambda k: F.struct(
            F.get(turns, F.get(bounds, k))["role"].alias("role"),
            F.transform(F.slice(turns, F.get(bounds, k) + 1, F.get(bounds, k + 1) - F.get(bounds, k)), lambda t: t["text"]).alias("texts"),
        ),
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: array of (block, start, length) for every conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    safe = F.transform("turns", lambda t: F.struct(escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    chats = chats.select("conv_id", safe.alias("turns")).select("conv_id", _runs(F.col("turns")).alias("blocks"))
    text = F.transform("blocks", lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END + "\n")))
    head, sep = F.lit(len(START) + 1), F.lit(len(SEP))

    def spans(b: Column, k: Column) -> Column:
        # Each text of a trained block starts after the block's head and the texts and separators before it.
        zero = F.struct(F.array().cast("array<struct<block:int,start:int,length:int>>").alias("out"), (head + F.length(b["role"])).alias("at"))
        grow = lambda a, x: F.struct(F.concat(a["out"], F.array(F.struct(k.alias("block"), a["at"].alias("start"), F.length(x).alias("length")))).alias("out"), (a["at"] + F.length(x) + sep).alias("at"))
        return F.when(b["role"] == TRAINED, F.aggregate(b["texts"], zero, grow, lambda a: a["out"])).otherwise(F.array().cast("array<struct<block:int,start:int,length:int>>"))

    return chats.select("conv_id", F.array_join(text, "").alias("formatted"), F.flatten(F.transform("blocks", spans)).alias("loss"))


def _blocks(formatted: Column) -> Column:
    """The blocks of a formatted conversation, as they stand in it."""
    parts = F.split(formatted, "(?=<\\|im_start\\|>)")
    return F.filter(parts, lambda p: p != "")


def parse_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text), loss_texts: the texts under the mask, read back from the output."""
    body = lambda b: F.substring(b, len(START) + 1, F.length(b) - len(START + END + "\n"))
    cut = formatted.withColumn("blocks", _blocks(F.col("formatted")))

    def turns(b: Column) -> Column:
        inner = body(b)
        role = F.substring_index(inner, "\n", 1)
        texts = F.split(F.substring(inner, F.length(role) + 2, F.length(inner)), "<\\|sep\\|>", -1)
        return F.transform(texts, lambda x: F.struct(unescape_role(role).alias("role"), unescape(x).alias("text")))

    # A mask's place is read in its own block, so a long conversation is not searched from its start each time.
    loss = F.transform("loss", lambda s: unescape(F.substring(F.get("blocks", s["block"]), s["start"] + 1, s["length"])))
    return cut.select("conv_id", "formatted", F.flatten(F.transform("blocks", turns)).alias("turns"), loss.alias("loss_texts"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    asked = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", asked), (-7, 1, "assistant", asked)], rows.schema)
    out = parse_chats(format_chats(rows.union(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as was,
         regexp_replace(replace(text, '~', '~0'), '(<)(\|(im_start|im_end|sep|endoftext)\|>|/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\4~1\2\5', 'g') as safe,
         replace(regexp_replace(replace(role, '~', '~0'), '(<)(\|(im_start|im_end|sep|endoftext)\|>|/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\4~1\2\5', 'g'), chr(10), '~2') as safe_role
  from c
)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(safe) + case when was is not distinct from role then length('<|sep|>') else length('<|im_start|>') + length(safe_role) + 1 + length('<|im_end|>') + 1 end)::bigint as formatted_chars
from e group by conv_id
"""
