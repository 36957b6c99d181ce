"""Chat formatting with cumulative snapshots collapsed.

Logs often hold a conversation several times, each snapshot with a few more turns. A conversation whose
whole sequence of (role, text) begins another, longer one is dropped; of equal conversations the one with
the smallest id stays. What is left is rendered with one template.

Turns are ordered by turn number (null last), then role and the text's MD5; a null role or text counts as empty.
A repeated turn row is a turn of its own. A window numbers each conversation's turns; each turn and its
number have an MD5, whose four words are summed along the conversation. The hash of a prefix is the MD5 of its four sums,
so that two conversations share a prefix where they share its hash and length. Work is linear in turns, but for
their sort, which spills; no conversation's hashes are held. Proper prefixes are made distinct before they
meet the conversations in an anti-join, and equal conversations are collapsed first, so that neither a common
first turn nor a common conversation gathers its rows in one task. One task still sorts the turns of one
conversation, and holds it if it stays, as its string is one value.

Rows without a conversation id are one conversation with a null id, as in the SQL twin. No rows: no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import staged

OPEN, ROLE_END, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def framed(role: Column, text: Column) -> Column:
    """A turn as one string from which role and text can be told apart."""
    return F.concat_ws(":", F.length(role).cast("string"), role, text)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and h of each prefix of the conversations, whole ones included (``whole``)."""
    ordered = Window.partitionBy("conv_id").orderBy("late", "turn", "role", "text_hash")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = turns.select(
        "conv_id", "late", "turn", "role", "text_hash", "h", F.row_number().over(ordered).alias("n_turns"),
        F.lead(F.lit(False), 1, True).over(ordered).alias("whole"),
    ).withColumn("placed", F.md5(F.concat_ws(":", F.col("n_turns").cast("string"), "h").cast("binary")))
    sums = [
        F.sum(F.conv(F.substring("placed", 8 * i + 1, 8), 16, 10).cast("long")).over(so_far).cast("string")
        for i in range(4)
    ]
    return numbered.select("conv_id", "n_turns", "whole", F.concat_ws(":", *sums).alias("sums")).select(
        "conv_id", "n_turns", "whole", F.md5(F.col("sums").cast("binary")).alias("h")
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that stay (clean columns)."""
    chains = staged(prefix_hashes(conversations), "chat-chains")
    whole_hash = chains.filter("whole")
    distinct = whole_hash.groupBy("h", "n_turns").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id")).alias("first"),
        F.count("*").alias("n_copies"),
    )
    prefixes = chains.filter("not whole").select("h", "n_turns").distinct()
    return distinct.join(prefixes, ["h", "n_turns"], "left_anti").select(
        F.col("first.conv_id").alias("conv_id"), F.col("n_turns").cast("long"), "n_copies"
    )


def chat_format(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies (equal ones) and rendered."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).isNull().alias("late"), F.col(turn_col).alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    hashed = turns.select(
        "conv_id", "late", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_hash"),
        F.md5(framed(F.col("role"), F.col("text")).cast("binary")).alias("h"),
    )
    keep = maximal(hashed)
    line = F.concat(
        F.lit(OPEN), F.col("role"), F.lit(ROLE_END), F.col("text"), F.lit(CLOSE)
    )
    rendered = turns.withColumn("text_hash", F.md5(F.col("text").cast("binary"))).join(
        keep.withColumnRenamed("conv_id", "kept_id"), F.col("conv_id").eqNullSafe(F.col("kept_id"))
    ).groupBy("kept_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("late", "turn", "role", "text_hash", line.alias("line")))).alias("turns")
    )
    return rendered.select(
        F.col("kept_id").alias("conv_id"), "n_turns", "n_copies",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("rendered"),
    )
