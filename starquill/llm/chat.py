"""Preference formatting: paired conversations as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.operators.rows import number_rows

LEARNED_ROLE = "assistant"
SEGMENT_TURNS = 256

# marks of the chat template
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def render_turn(role: Column, text: Column) -> tuple[Column, Column]:
    """The header of a turn, and its body with the closing mark.  Marks inside the text are
    broken up, so a text can't open or close a turn."""
    def safe(c: Column) -> Column:
        return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return (F.concat(F.lit(OPEN), safe(role), F.lit(AFTER_ROLE)), F.concat(safe(text), F.lit(CLOSE)))


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id",
                       turn: str = "turn", role: str = "role", text: str = "text",
                       segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """For every pair with turns on both sides: ``prompt``, ``chosen`` and ``rejected`` text, with
    ``chosen_spans`` and ``rejected_spans``, and the numbers of turns of the three.

    The prompt renders once the longest run of first turns whose role and text are equal on both
    sides; each completion renders the turns after it.  Spans are half-open character ranges of a
    completion that a loss should cover: bodies of assistant turns with their closing mark.
    Everything else (headers, other roles, the whole prompt) is masked.

    Turns are in the order of ``turn``, then role, then text; null sorts first.  Null role or text
    renders as empty, and equals only a null.  Repeated turns are turns of their own.  If one side
    is a prefix of the other, its completion is empty.  Pairs that lack a side, or whose id is
    null, give no row; empty tables give none; other columns aren't read.

    A row holds up to ``segment_turns`` turns of each of the three texts: an ordinary pair is one
    row with ``segment`` 0, an endless conversation is many, whose texts follow one another.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        header, body = render_turn(F.col(role), F.col(text))
        return df.filter(F.col(pair).isNotNull()).select(
            F.col(pair).alias("pair"), F.lit(name).alias("side"), F.col(turn).alias("turn"),
            F.col(role).alias("role"), F.col(text).alias("text"), header.alias("header"),
            body.alias("body"),
            F.coalesce(F.col(role) == LEARNED_ROLE, F.lit(False)).alias("learned"))

    turns = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    # places without a window per conversation, which may hold a third of all rows
    turns = number_rows(turns, ["turn", "role", "text"], "place", within=["pair", "side"])
    # role and text as one digest; nulls stay apart from empty text
    digest = F.sha2(F.to_json(F.struct("role", "text")), 256)
    met = turns.select("pair", "place", "side", digest.alias("digest")).groupBy("pair", "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"),
        F.count_if(F.col("side") == "chosen").alias("in_chosen"))
    differs = (F.col("n") == 1) | (F.col("low") != F.col("high"))
    splits = met.groupBy("pair").agg(
        (F.min(F.when(differs, F.col("place"))) - 1).alias("shared"),
        F.max("place").alias("longest"), F.sum("in_chosen").alias("n_chosen"),
        F.sum(F.col("n") - F.col("in_chosen")).alias("n_rejected"))
    splits = splits.filter("n_chosen > 0 AND n_rejected > 0").select(
        "pair", F.coalesce("shared", "longest").alias("shared"), "n_chosen", "n_rejected")

    placed = turns.join(splits, "pair").withColumn(
        "part", F.when(F.col("place") <= F.col("shared"), F.lit("prompt")).otherwise(F.col("side")))
    placed = placed.filter("part <> 'prompt' OR side = 'chosen'").withColumn(
        "at", F.col("place") - F.when(F.col("part") == "prompt", F.lit(0)).otherwise(F.col("shared")) - 1)
    placed = placed.withColumn("segment", F.floor(F.col("at") / F.lit(segment_turns)).cast("int"))

    def part(name: str) -> Column:
        # bounded by segment_turns
        return F.array_sort(F.collect_list(F.when(F.col("part") == name, F.struct(
            "at", "header", "body", "learned")))).alias(name)

    rows = placed.groupBy("pair", "segment", "shared", "n_chosen", "n_rejected").agg(
        part("prompt"), part("chosen"), part("rejected"))

    def joined(name: str) -> Column:
        return F.array_join(F.transform(name, lambda t: F.concat(t["header"], t["body"])), "")

    def spans(name: str) -> Column:
        none = F.array().cast("array<struct<start:int,end:int>>")

        def step(s: Column, t: Column) -> Column:
            start = s["at"] + F.length(t["header"])
            end = start + F.length(t["body"])
            return F.struct(end.alias("at"), F.when(t["learned"], F.concat(s["spans"], F.array(F.struct(
                start.alias("start"), end.alias("end"))))).otherwise(s["spans"]).alias("spans"))

        return F.aggregate(name, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]

    return rows.select(
        F.col("pair").alias(pair), "segment", joined("prompt").alias("prompt"),
        joined("chosen").alias("chosen"), joined("rejected").alias("rejected"),
        spans("chosen").alias("chosen_spans"), spans("rejected").alias("rejected_spans"),
        F.col("shared").alias("prompt_turns"),
        (F.col("n_chosen") - F.col("shared")).alias("chosen_turns"),
        (F.col("n_rejected") - F.col("shared")).alias("rejected_turns"))


def with_foreign_reply(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: each one that has an assistant turn is chosen;
    in its rejected twin the last assistant turn and all behind it give way to the last assistant
    turn of the conversation with the next id.  Conversations without such a next one are left out;
    ``with_next_reply`` keeps them.  Returns turns of the chosen and of the rejected, by ``pair_id``."""
    last = turns.filter(F.col("role") == LEARNED_ROLE).groupBy(key).agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    foreign = last.select((F.col(key) - 1).alias(key), F.col("last.text").alias("reply"))
    ends = last.select(key, F.col("last.turn").alias("end")).join(foreign, key)
    chosen = turns.select(key, "turn", "role", "text").join(ends, key)
    replies = ends.select(F.col(key).alias("pair_id"), F.col("end").alias("turn"),
                          F.lit(LEARNED_ROLE).alias("role"), F.col("reply").alias("text"))
    columns = [F.col(key).alias("pair_id"), "turn", "role", "text"]
    return (chosen.select(*columns),
            chosen.filter("turn < end").select(*columns).unionByName(replies))


def with_next_reply(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Preference pairs from all plain conversations, however their ids lie: as
    ``with_foreign_reply``, but the reply is that of the following conversation with an assistant
    turn in the order of ids, and that of the first for the last one.  A conversation without an
    assistant turn is the same on both sides, so it is all prompt.  Rows with a null id are left
    out.  Numbers the conversations by range partitioning, which runs jobs."""
    turns = turns.filter(F.col(key).isNotNull())
    last = turns.filter(F.col("role") == LEARNED_ROLE).groupBy(key).agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    last = number_rows(last, [key], "place")
    n = F.lit(max(1, last.count()))
    following = last.select((F.pmod(F.col("place") - 2, n) + 1).alias("place"),
                            F.col("last.text").alias("reply"))
    ends = last.select(key, F.col("last.turn").alias("end"), F.lit(True).alias("ended"), "place").join(
        following, "place").drop("place")
    chosen = turns.select(key, "turn", "role", "text").join(ends, key, "left")
    replies = ends.select(F.col(key).alias("pair_id"), F.col("end").alias("turn"),
                          F.lit(LEARNED_ROLE).alias("role"), F.col("reply").alias("text"))
    columns = [F.col(key).alias("pair_id"), "turn", "role", "text"]
    return (chosen.select(*columns),
            chosen.filter("ended IS NULL OR turn < end").select(*columns).unionByName(replies))
