"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one training example: all turns up to it as text, and only that
reply under the loss mask.  Turns after the last reply (a whole conversation without replies,
too) make one more example with an empty mask, so the output holds every turn.

Template of a turn: ``<s>`` role ``[INST]`` text ``[/INST]</s>``.  Within roles and texts a
backslash follows every ``<`` and ``[``, so no control string can occur there, and taking the
backslash after each ``<`` and ``[`` out again gives the original.

Places in the formatted conversation are running sums over its turns.  ``expand`` makes one row
of each example: its whole text, how long that is, where its mask lies, and the piece of text that
it adds to the example before it.  An example's text is its own piece behind those of the examples
before it; the texts of a conversation are together as long as their contexts make them, which
grows with the square of its turns.  The query makes every text and reads its results from the
texts, one at a time.  ``read_back`` without texts reads the pieces instead, in time in proportion
to the conversation.

Defined cases: a null role or text is empty; turns are ordered by turn (null last), then role,
then text; repeated rows are repeated turns; a null conv_id is a conversation; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.texts import sha256_hex, whole

# The template's control strings.
START, TEXT, STOP = "<s>", "[INST]", "[/INST]</s>"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<")), F.lit("[\\"), F.lit("["))


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit(TEXT))


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the ``formatted`` text and ``spans``.

    A span tells of each turn its ``start``, where its text begins (``lo``) and ends (``hi``),
    where the turn ends (``stop``), whether it is a ``target``, and the first ``example`` that
    it is part of: that of the next target, or one more behind the last target.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    sized = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.char_length(_head(role)).alias("head"), F.char_length(escape(text)).alias("body"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").isNull(), "turn", "role", "text"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.col("head") + F.col("body") + F.lit(len(STOP))
    target = F.col("role") == TARGET
    placed = sized.withColumns({
        "stop": F.sum(size).over(in_order),
        "targets": F.sum(target.cast("int")).over(in_order),
    })
    span = F.struct(
        (F.col("stop") - size).alias("start"),
        (F.col("stop") - size + F.col("head")).alias("lo"),
        (F.col("stop") - F.lit(len(STOP))).alias("hi"),
        "stop",
        target.alias("target"),
        (F.col("targets") - target.cast("int")).cast("int").alias("example"),
        F.concat(_head(F.col("role")), escape(F.col("text")), F.lit(STOP)).alias("piece"),
    )
    whole_ = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(span)).alias("turns"))
    return whole_.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t.dropFields("piece")).alias("spans"),
    )


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, ``n_chars``, ``loss_start``, ``loss_end``, ``added``,
    ``text``.

    The text is the first ``n_chars`` code points of the conversation: what the examples before
    it added, in order, then ``added``.  The mask covers the code points from ``loss_start`` up
    to but not ``loss_end``.
    """
    turns = formatted.select("conv_id", F.inline(F.arrays_zip(
        _pieces("formatted").alias("piece"), F.col("spans").alias("span"))))
    piece = F.struct("span.start", F.concat("piece", F.lit(STOP)).alias("piece"))
    place = {k: F.max(F.when(F.col("span.target"), F.col(f"span.{k}"))) for k in ("lo", "hi")}
    stop = F.max("span.stop")
    pieces = turns.groupBy("conv_id", F.col("span.example").alias("example")).agg(
        stop.alias("n_chars"),
        F.coalesce(place["lo"], stop).alias("loss_start"),
        F.coalesce(place["hi"], stop).alias("loss_end"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(piece)), lambda t: t["piece"]), ""
        ).alias("added"),
    )
    upto = Window.partitionBy("conv_id").orderBy("example").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return pieces.withColumn("text", F.array_join(F.collect_list("added").over(upto), ""))


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, ``text``, ``loss_start`` and ``loss_end``.

    The mask covers the code points of the text from ``loss_start`` up to but not ``loss_end``.
    """
    return expand(conversations(turns)).select(
        "conv_id", "example", "text", "loss_start", "loss_end")


def _pieces(formatted: str) -> Column:
    """The turns of a formatted text, without their ends."""
    pieces = F.split(formatted, r"\Q" + STOP + r"\E", -1)
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def _said(piece: Column) -> Column:
    """Role and text of a turn, unescaped, each with a line end."""
    role = F.substring_index(F.substring(piece, len(START) + 1, 1 << 30), TEXT, 1)
    text = F.substring(piece, F.locate(TEXT, piece) + len(TEXT), 1 << 30)
    return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))


def read_back(formatted: DataFrame, texts: bool = False) -> DataFrame:
    """Per conversation, from the rows of its examples: turns, masked text and sizes.

    With ``texts`` all of it is read from the examples' whole texts, else from their pieces.
    """
    chars, own = F.col("n_chars"), F.col("added")
    if texts:
        # The end of a text is cut off by bytes, which needs no search for its code points.
        chars = F.char_length("text").cast("long")
        before = F.octet_length("text") - F.octet_length("added")
        own = F.substr(F.col("text").cast("binary"), before + 1).cast("string")
    begin = F.col("n_chars") - F.char_length("added")
    rows = expand(formatted).select(
        "conv_id", "example", chars.alias("chars"), own.alias("own"),
        (F.col("loss_start") - begin + 1).cast("int").alias("at"),
        (F.col("loss_end") - F.col("loss_start")).cast("int").alias("masked"),
    )
    pieces = _pieces("own")
    read = F.struct(
        "example",
        unescape(F.substr("own", "at", "masked")).alias("learnt"),
        F.array_join(F.transform(pieces, _said), "").alias("said"),
    )
    whole_ = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(read)).alias("read"),
        F.sum(F.size(pieces).cast("long")).alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    learnt = F.array_join(F.transform("read", lambda e: e["learnt"]), "")
    said = F.array_join(F.transform("read", lambda e: e["said"]), "")
    return whole_.select(
        "conv_id", "n_turns",
        sha256_hex(said).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        sha256_hex(learnt).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    control = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"),
        F.lit(control).alias("text"),
    )
    used = turns.select("conv_id", "turn", "role", "text").unionByName(planted)
    return read_back(conversations(used), texts=True)


SQL = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n as (
  select *, {len(START) + len(TEXT) + len(STOP)}
    + 2 * length(role) - length(replace(replace(role, '<', ''), '[', ''))
    + 2 * length(text) - length(replace(replace(text, '<', ''), '[', '')) as n,
    row_number() over (partition by conv_id order by turn nulls last, role, text) as i
  from t),
p as (
  select *, sum(n) over (partition by conv_id order by i) as prefix,
    i = max(i) over (partition by conv_id) as last from n)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), ''))
    as loss_sha256,
  (coalesce(sum(prefix) filter (role = 'assistant'), 0)
    + coalesce(sum(prefix) filter (last and role <> 'assistant'), 0))::bigint as formatted_chars
from p group by conv_id
"""

QUERIES = {"op4_chat_format": op4_chat_format}
ORACLES = {"op4_chat_format": SQL}
