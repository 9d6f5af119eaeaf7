"""Chat formatting by prefix-target expansion, in DataFrame expressions only.

Every assistant turn becomes an example of its own: all preceding turns are its
context, only that reply is trainable.  The preceding turns of all examples of
a conversation are prefixes of one formatted text, so that text is stored once
(``segments``, one row a turn) and an example (``examples``) is a span triple
over it: context ``[0, context_end)``, target ``[target_start, target_end)``.
The output is linear in the conversation; writing each context out would be
quadratic.  ``expand_examples`` spells single examples out where a trainer
wants whole strings.

A turn is formatted as ``<s>role\\ntext\\n</s>\\n``.  Control strings inside a
text get one more backslash in front (also those that already have some), so
removing one backslash restores the text exactly; the role's backslashes and
newlines are escaped.

Defined cases: a null role or text is empty; a null conversation id is a
conversation of its own; null turns come first; rows of one turn are ordered by
a hash of role and text, so repeated rows are kept and interchangeable; an
empty reply is an example with an empty target; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalspark.session import work_path

# Strings that mark turns in common chat templates.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>"]
_ANY = "(?:" + "|".join("".join("\\" + c if c in "[]|<>/" else c for c in s) for s in CONTROL) + ")"

# Running sums over a conversation are taken in blocks of so many turn numbers,
# then over the blocks, so one long conversation is spread over many tasks.
TURN_BLOCK = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{_ANY})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{_ANY})", "$1")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # left to right: a doubled backslash is one backslash, a backslash and an n is a newline
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def segments(rows: DataFrame) -> DataFrame:
    """One formatted row a turn: conv_id, turn, tie, trainable, segment, body_start, body_chars
    (the text's place in the segment, in code points).  No shuffle."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    out = rows.select("conv_id", "turn", F.xxhash64(role, text).alias("tie"),
                      (role == "assistant").alias("trainable"),
                      F.concat(F.lit("<s>"), _escape_role(role), F.lit("\n")).alias("head"),
                      escape(text).alias("body"))
    return out.select("conv_id", "turn", "tie", "trainable",
                      F.concat("head", "body", F.lit("\n</s>\n")).alias("segment"),
                      F.length("head").alias("body_start"), F.length("body").alias("body_chars"))


def examples(segs: DataFrame) -> DataFrame:
    """One row an assistant turn: conv_id, turn, example_no, context_end, target_start, target_end,
    as code-point offsets in the conversation's formatted text.  Only lengths are shuffled."""
    rows = segs.select("conv_id", "turn", "tie", "trainable", F.length("segment").cast("long").alias("chars"),
                       "body_start", "body_chars", F.floor(F.col("turn") / TURN_BLOCK).alias("block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "tie", "chars")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("offset"),
                       F.coalesce(F.sum(F.col("trainable").cast("long")).over(before), F.lit(0)).alias("nth"))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("chars").alias("b_chars"),
                                                  F.sum(F.col("trainable").cast("long")).alias("b_n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
                           F.coalesce(F.sum("b_chars").over(earlier), F.lit(0)).alias("b_offset"),
                           F.coalesce(F.sum("b_n").over(earlier), F.lit(0)).alias("b_nth"))
    start = F.col("offset") + F.col("b_offset")
    return (rows.where("trainable")
            .join(blocks, F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block")))
            .select("conv_id", "turn", (F.col("nth") + F.col("b_nth")).alias("example_no"),
                    start.alias("context_end"), (start + F.col("body_start")).alias("target_start"),
                    (start + F.col("body_start") + F.col("body_chars")).alias("target_end")))


def write_chat(rows: DataFrame, path: str) -> None:
    """Write both tables below ``path``: ``segments`` and ``examples``."""
    spark = rows.sparkSession
    segments(rows).write.mode("overwrite").parquet(f"{path}/segments")
    examples(spark.read.parquet(f"{path}/segments")).write.mode("overwrite").parquet(f"{path}/examples")


def conversations(segs: DataFrame) -> DataFrame:
    """The formatted text of each conversation and its turns read back from it.

    One row holds one whole conversation, which a digest of it needs; the
    tables themselves never gather one."""
    role = _unescape_role(F.regexp_extract("segment", r"^<s>([^\n]*)\n", 1))
    text = unescape(F.regexp_extract("segment", r"(?s)^<s>[^\n]*\n(.*)\n</s>\n$", 1))
    parts = F.array_sort(F.collect_list(F.struct("turn", "tie", "chars", "segment", "said")),
                         lambda a, b: F.when(_key(a) < _key(b), -1).when(_key(a) > _key(b), 1).otherwise(0))
    return (segs.select("conv_id", "turn", "tie", F.length("segment").alias("chars"), "segment",
                        F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"))
            .groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), parts.alias("parts"))
            .select("conv_id", "n_turns", F.array_join("parts.segment", "").alias("formatted"),
                    F.array_join("parts.said", "").alias("said")))


def _key(x: Column) -> Column:
    return F.struct(x["turn"].isNotNull(), F.coalesce(x["turn"], F.lit(0)), x["tie"], x["chars"])


def expand_examples(convs: DataFrame, exs: DataFrame) -> DataFrame:
    """Examples spelled out: conv_id, example_no, context, target (still escaped).  Its size is the sum
    of all prefixes, so select the examples wanted first."""
    c = convs.select(F.col("conv_id").alias("c_conv"), "formatted")
    return exs.join(c, F.col("conv_id").eqNullSafe(F.col("c_conv"))).select(
        "conv_id", "example_no", F.expr("substring(formatted, 1, int(context_end))").alias("context"),
        F.expr("substring(formatted, int(target_start) + 1, int(target_end - target_start))").alias("target"))


def digests(path: str, spark: SparkSession) -> DataFrame:
    """What the written tables say of each conversation, as digests."""
    convs = conversations(spark.read.parquet(f"{path}/segments"))
    spans = (spark.read.parquet(f"{path}/examples")
             .groupBy(F.col("conv_id").alias("s_conv"))
             .agg(F.array_sort(F.collect_list(F.struct("example_no", "target_start", "target_end"))).alias("spans")))
    cut = F.array_join(F.transform(F.coalesce("spans", F.array().cast("array<struct<example_no:bigint,target_start:bigint,target_end:bigint>>")),
                                   lambda s: unescape(F.substring(F.col("formatted"), (s["target_start"] + 1).cast("int"),
                                                                  (s["target_end"] - s["target_start"]).cast("int")))), "")
    return (convs.join(spans, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
            .select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                    cut.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user'), (-1L, 1L, 'assistant') AS t(conv_id, turn, role)")
    rows = (spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
            .unionByName(probe.withColumn("text", F.lit(said))))
    path = work_path(spark, "chat")
    write_chat(rows, path)
    return digests(path, spark)


_DUCK_ANY = _ANY.replace("'", "''")
ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT *, role || chr(10) || text || chr(10) AS line,
    regexp_replace(text, '(\\*{_DUCK_ANY})', '\\\1', 'g') AS body FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(line, '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(body) + 10) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""
