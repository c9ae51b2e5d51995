"""Chat formatting: snapshots of a growing conversation collapse to the longest, which is rendered.

A prefix of a conversation is known by its length and four running sums over hashes of (position, role, text). Sums
roll from turn to turn, and a conversation that is a prefix of a longer one has its length and sums among the
other's proper prefixes. Anti-joins keep what no longer conversation begins with. All of it is DataFrame work; a
conversation of any length is numbered, summed and rendered in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.session import materialise

# Turn numbers of a block that one window orders; turns of a rendered part.
BLOCK, PART = 1024, 256
# The marks of the chat template. An opening mark inside a text or role is spaced out.
START, END, OPEN, SPACED = "<|im_start|>", "<|im_end|>", "<|", "< |"

SUMS = ["s1", "s2", "s3", "s4"]
LOW = (1 << 32) - 1


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, a, b): a and b are hashes of role and text that tell NULL from empty."""
    df = conversations.select(
        quoted(conv).cast("long").alias("conv"),
        quoted(turn).cast("long").alias("turn"),
        quoted(role).cast("string").alias("role"),
        quoted(text).cast("string").alias("text"),
    ).where("conv IS NOT NULL")
    content = [F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return df.withColumns({"a": F.xxhash64(F.lit(1), *content), "b": F.xxhash64(F.lit(2), *content)})


def _halves(value: Column) -> list[Column]:
    """A 64-bit hash as two numbers whose sums stay far from overflow."""
    return [value.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(value, 32)]


def prefix_sums(turns: DataFrame) -> DataFrame:
    """(conv, turn, a, b, position from 1, s1 to s4 up to here) for the distinct turns of each conversation, ordered by
    turn (NULL first), then hashes. Blocks of turn numbers are ordered apart and offset by what comes before."""
    rows = turns.select("conv", "turn", "a", "b").distinct()
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv", "block").orderBy("turn", "a", "b")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(per_block: DataFrame, columns: list[str]) -> DataFrame:
        sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns]
        return per_block.select(F.col("conv").alias("c"), F.col("block").alias("k"), *sums)

    def offset(df: DataFrame, columns: list[str], per_block: DataFrame) -> DataFrame:
        same = (df["conv"] == F.col("c")) & df["block"].eqNullSafe(F.col("k"))
        joined = df.join(before(per_block, columns), same)
        return joined.withColumns({c: F.col(c) + F.col(f"{c}_before") for c in columns}).drop(
            "c", "k", *[f"{c}_before" for c in columns]
        )

    numbered = rows.withColumn("position", F.row_number().over(inside).cast("long"))
    counts = rows.groupBy("conv", "block").agg(F.count("*").alias("position"))
    numbered = offset(numbered, ["position"], counts)
    parts = [*_halves(F.xxhash64("position", "a")), *_halves(F.xxhash64("position", "b"))]
    numbered = numbered.withColumns(dict(zip(SUMS, parts, strict=True)))
    totals = numbered.groupBy("conv", "block").agg(*[F.sum(s).alias(s) for s in SUMS])
    rolling = inside.rowsBetween(Window.unboundedPreceding, 0)
    rolled = numbered.withColumns({s: F.sum(s).over(rolling) for s in SUMS})
    return offset(rolled, SUMS, totals).drop("block")


def maximal(sums: DataFrame) -> DataFrame:
    """(conv, n_turns) of the conversations that begin no longer one; of equal ones, the smallest conv."""
    ends = sums.groupBy("conv").agg(F.max(F.struct("position", *SUMS)).alias("end"))
    ends = ends.select("conv", "end.*")
    # Equal conversations are one before the join, and each proper prefix is there once: no key is hot.
    distinct_ends = ends.groupBy("position", *SUMS).agg(F.min("conv").alias("conv"))
    lengths = ends.select("conv", F.col("position").alias("n_turns"))
    prefixes = sums.join(lengths, "conv").where("position < n_turns").select("position", *SUMS).distinct()
    kept = distinct_ends.join(prefixes, ["position", *SUMS], "left_anti")
    return kept.select("conv", F.col("position").alias("n_turns"))


def rendered(column: Column) -> Column:
    return F.replace(F.coalesce(column, F.lit("")), F.lit(OPEN), F.lit(SPACED))


def format_chats(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per part of a maximal conversation: its id, part (from 0, of 256 turns each), n_turns (of the conversation) and
    the rendered text. The parts of a conversation, in order, are its text.

    Turns are ordered by number (NULL first); turns that share one by a hash of role and text. A turn logged twice
    with equal role and text counts once. NULL roles and texts differ from empty ones in comparisons and
    are rendered as empty. Rows without a conversation id are left out; columns of other names are ignored; an empty
    table gives none. Conversations equal throughout are kept once, under the smallest id.
    """
    turns = _turns(conversations, conv, turn, role, text)
    sums = materialise(prefix_sums(turns), "prefixes")
    places = sums.select("conv", "turn", "a", "b", "position").join(maximal(sums), "conv")
    places = places.select(*[F.col(c).alias(f"p_{c}") for c in places.columns])
    same = (
        (F.col("conv") == F.col("p_conv"))
        & F.col("turn").eqNullSafe(F.col("p_turn"))
        & (F.col("a") == F.col("p_a"))
        & (F.col("b") == F.col("p_b"))
    )
    line = F.concat(F.lit(START), rendered(F.col("role")), F.lit("\n"), rendered(F.col("text")), F.lit(END + "\n"))
    part = F.floor((F.col("p_position") - 1) / PART).cast("int")
    lines = turns.join(places, same).select(
        F.col("conv").alias("conv"), part.alias("part"), "p_n_turns", F.struct("p_position", line.alias("line")).alias("l")
    )
    # A repeated row gives the same line at the same position, which the set holds once.
    parts = lines.groupBy("conv", "part", "p_n_turns").agg(F.sort_array(F.collect_set("l")).alias("l"))
    return parts.select(
        F.col("conv").alias(conv),
        "part",
        F.col("p_n_turns").alias("n_turns"),
        F.array_join(F.col("l.line"), "").alias("text"),
    )
