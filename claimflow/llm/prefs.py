"""Preference pairs as one prompt and two completions with training masks.

The longest common prefix of turns of a chosen and a rejected conversation is
rendered once as the prompt; what follows it in each becomes a completion, with
the spans of characters that are trained on: the assistant's words and their
end mark.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def rendered(turns: Column) -> Column:
    """The turns in the chat template, one after the other."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE + "\n"))), "")


def trained_spans(turns: Column) -> Column:
    """[start, end) character spans of the rendered turns that are trained on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + F.length(_head(t))
        last = first + F.length(t["text"]) + len(CLOSE)
        mine = F.array(F.struct(first.alias("start"), last.alias("end")))
        return F.struct((last + 1).alias("at"), F.when(t["role"] == TRAINED, F.concat(state["spans"], mine))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def common_turns(one: Column, two: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    n = F.least(F.size(one), F.size(two))
    same = F.zip_with(F.slice(one, 1, n), F.slice(two, 1, n),
                      lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    at = F.array_position(same, F.lit(False))
    return F.when(at == 0, n).otherwise(at.cast("int") - 1)


def _filled(turns: Column) -> Column:
    return F.transform(F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>")),
                       lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"),
                                          F.coalesce(t["text"], F.lit("")).alias("text")))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (``chosen``, ``rejected``: arrays of (role, text)) as training examples.

    Adds ``prompt_turns``, ``prompt``, ``chosen_completion``, ``chosen_spans``,
    ``rejected_completion``, ``rejected_spans`` in place of the two arrays.  A null
    role or text counts as empty, a null array as no turns.  A conversation that
    the other begins with has an empty completion; equal ones have two.  Further
    columns pass through unless their names clash with the added ones, which win.
    """
    kept = [c for c in pairs.columns if c not in
            {"chosen", "rejected", "prompt_turns", "prompt", "chosen_completion", "chosen_spans",
             "rejected_completion", "rejected_spans"}]
    # positions stand in for the further columns' names, so that none of them can clash
    held = {c: f"c{k}" for k, c in enumerate(kept)}
    filled = pairs.select(*[F.col(f"`{c}`").alias(k) for c, k in held.items()], _filled(F.col("chosen")).alias("chosen"),
                          _filled(F.col("rejected")).alias("rejected"))
    split = filled.withColumn("prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("prompt_turns") + 1, F.greatest(F.size(name) - F.col("prompt_turns"), F.lit(0)))

    return split.select(
        *[F.col(k).alias(c) for c, k in held.items()], "prompt_turns",
        rendered(F.slice("chosen", 1, F.col("prompt_turns"))).alias("prompt"),
        rendered(rest("chosen")).alias("chosen_completion"), trained_spans(rest("chosen")).alias("chosen_spans"),
        rendered(rest("rejected")).alias("rejected_completion"), trained_spans(rest("rejected")).alias("rejected_spans"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order.

    Turns with equal numbers are ordered by role and text, null first; rows without
    a conv_id belong to no conversation.
    """
    entry = F.struct("turn", "role", "text")
    return turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(entry)).alias("turns")).select(
        "conv_id", _filled(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
        .alias("turns"))


def reply_pairs(talks: DataFrame) -> DataFrame:
    """A pair from every conversation: (conv_id, chosen, rejected).

    Chosen is the whole conversation.  Rejected has another text in place of one assistant
    turn and keeps the turns that follow: of ``r`` such turns the one numbered (turns modulo
    r, from 0) gets the text of the next, the last one that of the first, a fluent but
    misplaced reply.  A single reply is replaced by an empty one; a conversation without a
    reply is rejected as it is, so that all of it is prompt.
    """
    at = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda k: F.get("turns", k - 1)["role"] == TRAINED)
    marked = talks.withColumn("at", F.when(F.size("turns") > 0, at).otherwise(F.array().cast("array<int>")))
    replies = F.size("at")
    place = F.when(replies > 0, F.size("turns") % F.greatest(replies, F.lit(1)))
    marked = marked.withColumn("spot", F.get("at", place)).withColumn("wrong", F.when(
        replies > 1, F.get("turns", F.get("at", (place + 1) % F.greatest(replies, F.lit(1))) - 1)["text"]).otherwise(F.lit("")))
    rejected = F.transform("turns", lambda t, k: F.struct(t["role"].alias("role"), F.when(
        k + 1 == F.col("spot"), F.col("wrong")).otherwise(t["text"]).alias("text")))
    return marked.select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the preference pair of every conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = format_pairs(reply_pairs(conversations(turns)))

    def trained(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])

    return pairs.select(
        "conv_id", "prompt_turns", F.md5("prompt").alias("prompt_md5"),
        F.md5("chosen_completion").alias("chosen_md5"), trained("chosen_spans").alias("chosen_trained"),
        F.md5("rejected_completion").alias("rejected_md5"), trained("rejected_spans").alias("rejected_trained"))


OP6_SQL = """
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
a AS (
  SELECT conv_id, turns, list_filter(range(1, len(turns) + 1), lambda k: turns[k].role = 'assistant') AS spots FROM c),
p AS (
  SELECT conv_id, turns, CASE WHEN len(spots) > 0 THEN spots[len(turns) % len(spots) + 1] END AS spot,
         CASE WHEN len(spots) > 1 THEN turns[spots[(len(turns) % len(spots) + 1) % len(spots) + 1]].text ELSE '' END AS wrong
  FROM a),
r AS (
  SELECT conv_id, turns AS chosen, list_transform(range(1, len(turns) + 1), lambda k:
           {'role': turns[k].role, 'text': CASE WHEN k = spot THEN wrong ELSE turns[k].text END}) AS rejected
  FROM p),
n AS (
  SELECT *, coalesce(list_min(list_filter(range(1, len(chosen) + 1), lambda k: chosen[k] <> rejected[k])) - 1, len(chosen)) AS n
  FROM r),
s AS (
  SELECT conv_id, n,
         list_transform(chosen, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS good,
         list_transform(rejected, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS bad,
         list_transform(chosen, lambda t: CASE WHEN t.role = 'assistant' THEN length(t.text) + 10 ELSE 0 END) AS good_trained,
         list_transform(rejected, lambda t: CASE WHEN t.role = 'assistant' THEN length(t.text) + 10 ELSE 0 END) AS bad_trained
  FROM n)
SELECT conv_id, CAST(n AS INTEGER) AS prompt_turns,
       md5(coalesce(array_to_string(good[1:n], ''), '')) AS prompt_md5,
       md5(coalesce(array_to_string(good[n + 1:], ''), '')) AS chosen_md5,
       CAST(coalesce(list_sum(good_trained[n + 1:]), 0) AS INTEGER) AS chosen_trained,
       md5(coalesce(array_to_string(bad[n + 1:], ''), '')) AS rejected_md5,
       CAST(coalesce(list_sum(bad_trained[n + 1:]), 0) AS INTEGER) AS rejected_trained
FROM s
"""
