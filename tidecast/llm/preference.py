"""Preference formatting: the common turns as a prompt, and two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import WORD, table

OPEN, CLOSE = "<|", "|>"
TURNS = "array<struct<role:string,text:string>>"


def render(turn: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit(f"{OPEN}start{CLOSE}"), turn["role"], F.lit("\n"), turn["text"], F.lit(f"{OPEN}end{CLOSE}\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def mask(turns: Column) -> Column:
    """Spans (code points) of the rendered turns that carry loss: assistants' texts with their end marks."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(seen: Column, turn: Column) -> Column:
        end = seen["at"] + F.length(render(turn))
        start = seen["at"] + F.lit(len(f"{OPEN}start{CLOSE}\n")) + F.length(turn["role"])
        span = F.struct(start.alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(turn["role"] == "assistant", F.array_append(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    return F.aggregate(turns, begin, step, lambda seen: seen["spans"])


def common_turns(x: Column, y: Column) -> Column:
    """Length of the longest common prefix of two conversations."""
    n = F.least(F.size(x), F.size(y))
    equal = F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    differ = F.array_position(equal, F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(n).cast("int")


def conversations_of(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns) with the turns in order; a conversation is one row, as its text is one text."""
    plain = lambda c: F.replace(F.coalesce(turns[c], F.lit("")), F.lit(OPEN), F.lit("< |"))  # noqa: E731  no text can close a turn
    rows = turns.select(turns[conv_id].alias("conv_id"), turns[turn].alias("turn"), plain(role).alias("role"), plain(text).alias("text")).where("conv_id is not null")
    ordered = F.array_sort(F.collect_set(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "text")))
    grouped = rows.groupBy("conv_id").agg(ordered.alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Add n_prefix, prompt, chosen_text, rejected_text, chosen_mask, rejected_mask to (chosen, rejected) turns.

    The longest common prefix of turns is rendered once, as the prompt; what follows on either side is
    that side's completion, with the spans of its assistant turns as its mask. Equal sides have empty
    completions, sides without a common turn an empty prompt.
    """
    split = pairs.withColumn("n_prefix", common_turns(F.col("chosen"), F.col("rejected")))
    rest = {side: F.slice(side, F.col("n_prefix") + 1, F.size(side)) for side in ("chosen", "rejected")}
    return split.select(
        *pairs.columns, "n_prefix", rendered(F.slice("chosen", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        *[rendered(r).alias(f"{side}_text") for side, r in rest.items()], *[mask(r).alias(f"{side}_mask") for side, r in rest.items()],
    )


def shortened(turns: Column) -> Column:
    """The conversation with the last assistant turn cut to the first half of its words."""
    roles = F.transform(turns, lambda t: t["role"])
    last = F.size(turns) - F.array_position(F.reverse(roles), "assistant") + 1
    words = lambda t: F.regexp_extract_all(t["text"], F.lit(WORD), F.lit(0))
    half = lambda t: F.array_join(F.slice(words(t), F.lit(1), F.floor(F.size(words(t)) / 2).cast("int")), " ")
    cut = F.transform(turns, lambda t, i: F.struct(t["role"].alias("role"), F.when(i + 1 == last, half(t)).otherwise(t["text"]).alias("text")))
    return F.when(F.array_contains(roles, "assistant"), cut).otherwise(turns)


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One pair per conversation: conv_id, rejected_id, chosen, rejected.

    The chosen side is the conversation itself. The rejected side is the smallest conv_id that opens with the
    same turn (for that one, the greatest), so a common opening makes as many pairs as conversations, not
    all; a conversation whose opening is its own is set against itself with a shortened answer
    (rejected_id null). Turns that repeat a row are one; turns of equal number go by role and text, those
    without a number come first; a null role or text is empty; turns without a conv_id belong to none.
    """
    whole = materialise(conversations_of(turns), "conversations")
    opening = [F.xxhash64(F.lit(s), F.col("turns")[0]).alias(s) for s in ("k1", "k2")]
    openings = materialise(whole.select("conv_id", *opening), "openings")
    ends = materialise(openings.groupBy("k1", "k2").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).where("low <> high"), "shared-openings")
    partner = openings.join(ends, ["k1", "k2"]).select(F.col("conv_id").alias("own_id"), F.when(F.col("conv_id") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("rejected_id"))
    partner = materialise(partner, "partners")
    left = whole.join(partner, whole["conv_id"] == partner["own_id"], "left").select("conv_id", "rejected_id", F.col("turns").alias("chosen"))
    right = whole.select(F.col("conv_id").alias("other_id"), F.col("turns").alias("other"))
    met = left.join(right, left["rejected_id"] == right["other_id"], "left")
    return met.select("conv_id", "rejected_id", "chosen", F.coalesce("other", shortened(F.col("chosen"))).alias("rejected"))


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_pairs(preference_pairs(table(spark, sf_dir, "conversations")))
    digest = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("prompt", "chosen_text", "rejected_text")]
    spans = [F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias(c) for c in ("chosen_mask", "rejected_mask")]
    return pairs.select("conv_id", "rejected_id", "n_prefix", *digest, *spans)


_RENDER = "'<|start|>' || t.role || chr(10) || t.text || '<|end|>' || chr(10)"
_MASK = """array_to_string(list_transform(list_filter(range(1, len({0}) + 1), lambda i: ({0})[i].role = 'assistant'), lambda i:
  (coalesce(list_sum(list_transform(({0})[1:i - 1], lambda t: length({1}))), 0) + 10 + length(({0})[i].role))::BIGINT || ':' ||
  (list_sum(list_transform(({0})[1:i], lambda t: length({1}))) - 1)::BIGINT), ',')"""
SQL = f"""
WITH r AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM r GROUP BY conv_id
), o AS (
  SELECT *, min(conv_id) OVER w AS low, max(conv_id) OVER w AS high FROM c WINDOW w AS (PARTITION BY turns[1])
), p AS (
  SELECT conv_id, turns, CASE WHEN low <> high THEN CASE WHEN conv_id = low THEN high ELSE low END END AS rejected_id,
         list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS last FROM o
), s AS (
  SELECT p.conv_id, p.rejected_id, p.turns AS chosen, coalesce(x.turns, CASE WHEN last IS NULL THEN p.turns ELSE
    list_transform(range(1, len(p.turns) + 1), lambda i: {{'role': p.turns[i].role, 'text': CASE WHEN i = last THEN
      array_to_string((regexp_extract_all(p.turns[i].text, '[^\\x20\\x09-\\x0D]+'))[1:len(regexp_extract_all(p.turns[i].text, '[^\\x20\\x09-\\x0D]+')) // 2], ' ')
      ELSE p.turns[i].text END}}) END) AS rejected
  FROM p LEFT JOIN c x ON x.conv_id = p.rejected_id
), n AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[i] <> rejected[i])) - 1, least(len(chosen), len(rejected)))::INT AS n_prefix FROM s
), e AS (
  SELECT conv_id, rejected_id, n_prefix, chosen[1:n_prefix] AS p, chosen[n_prefix + 1:] AS x, rejected[n_prefix + 1:] AS y FROM n
)
SELECT conv_id, rejected_id, n_prefix, sha256(array_to_string(list_transform(p, lambda t: {_RENDER}), '')) AS prompt_sha256,
  sha256(array_to_string(list_transform(x, lambda t: {_RENDER}), '')) AS chosen_text_sha256,
  sha256(array_to_string(list_transform(y, lambda t: {_RENDER}), '')) AS rejected_text_sha256,
  {_MASK.format('x', _RENDER)} AS chosen_mask, {_MASK.format('y', _RENDER)} AS rejected_mask FROM e
"""
