"""Chat formatting from event logs, in DataFrame functions alone.

A log has rows (conv_id, seq, msg, kind, role, text). Conversations are dealt by conv_id and sorted by seq; messages are
ordered by msg. Kinds: `message` and `edit` set a message's text, `delta` appends to it, `regenerate` empties it and
drops what later messages had so far, `delete` removes it. The folded messages are rendered with turn marks, and the
parts that a model learns from (assistant texts) are marked by (start, length) in code points.

Control strings inside texts get a backslash after their first character, and backslashes are doubled; dropping a
backslash before any character undoes it. Roles are URL-encoded, so that a mark's line ends where the role does.

Defined results: null texts and roles are empty. Rows of one turn are separate turns, ordered by role and text; a null
turn comes first. Rows with a null conv_id are one conversation. An empty table gives only conversation -7 in the
query. Other columns are ignored. Texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Strings that mark something in common templates, ours included (all of which begin with <|).
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]"]
LEARNED = "assistant"
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events(rows: DataFrame) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): each row a message."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", place.alias("seq"), place.alias("msg"), F.lit("message").alias("kind"), "role", "text")


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text) of the messages that stand at the end of the log."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    log = log.select("conv_id", "seq", "msg", "kind", role.alias("role"), text.alias("text"))
    earlier = W.partitionBy("conv_id").orderBy("msg").rangeBetween(W.unboundedPreceding, -1)
    log = log.withColumn("_cut", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier))
    log = log.where(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut")))
    sets = F.max(F.when(F.col("kind") != "delta", F.col("seq"))).over(W.partitionBy("conv_id", "msg"))
    log = log.withColumn("_set", sets).where(F.col("_set").isNull() | (F.col("seq") >= F.col("_set")))
    parts = F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text")))
    folded = log.groupBy("conv_id", "msg").agg(parts.alias("_p"))
    named = F.filter(F.transform("_p", lambda p: p["role"]), lambda r: r != "")
    gone = F.exists("_p", lambda p: p["kind"] == "delete")
    shown = F.transform("_p", lambda p: F.when(p["kind"] == "regenerate", F.lit("")).otherwise(p["text"]))
    folded = folded.where(~gone)
    return folded.select("conv_id", "msg", F.coalesce(F.try_element_at(named, F.lit(-1)), F.lit("")).alias("role"), F.array_join(shown, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one text per conversation, and its learned parts as (start, length)."""
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit("\n"))
    turns = messages.select("conv_id", "msg", (F.col("role") == LEARNED).alias("_learn"), head.alias("_head"), escape(F.col("text")).alias("_body"))
    turns = turns.withColumn("_turn", F.concat("_head", "_body", F.lit(CLOSE)))
    before = W.partitionBy("conv_id").orderBy("msg").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("_turn")).over(before), F.lit(0)) + F.char_length("_head")
    turns = turns.select("conv_id", "msg", "_learn", "_turn", start.cast("long").alias("start"), F.char_length("_body").cast("long").alias("length"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("msg", "_turn", "_learn", "start", "length"))).alias("_t"))
    learned = F.transform(F.filter("_t", lambda t: t["_learn"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return listed.select("conv_id", F.array_join(F.transform("_t", lambda t: t["_turn"]), "").alias("formatted"), learned.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with turns (role, text) and learned (the texts under the loss mask), read from the formatted text."""
    whole = F.split("formatted", r"<\|im_end\|>\n")
    turns = F.slice(whole, 1, F.size(whole) - 1)

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        text = F.substr(t, F.char_length(role) + 2)
        return F.struct(F.url_decode(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(text).alias("text"))

    learned = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", F.transform(turns, turn)).withColumn("learned", learned)


def format_log(log: DataFrame) -> DataFrame:
    return render(fold(log))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), F.lit(PROBE).alias("text"))
    out = read_back(format_log(events(rows.unionByName(probe))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = "replace(text, chr(92), chr(92) || chr(92))"
for _mark in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}' || chr(92) || '{_mark[1:]}')"

QUERIES = {"op8_chat_formatting": op8_chat_formatting}
SQL = {
    "op8_chat_formatting": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, '{LEARNED}', '{PROBE}')),
a AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LEARNED}'), '') AS learned,
    sum(length(url_encode(role)) + length({_ESCAPED}) + {len(OPEN) + 1 + len(CLOSE)}) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM a"""
}
