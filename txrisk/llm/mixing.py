"""Mixing sources to target weights.

Each document has a hash-random key, from its id. Within a source, documents are ranged by key, and the
mix takes them in that order until the source's budget of words is used up: whole passes over the
source first, then a last pass up to the exact word. So at most one document per source is taken in
part. Sizes are words; a null text has none.

The order is distributed: a source's keys are dealt into ranges of equal width (keys are uniform, so
ranges are even), range totals are summed first, and each range then only adds the total of
those before it. A source with any share of the rows is spread over all ranges, and neither targets
nor the words taken depend on the number of ranges. A range that holds far more rows than its share, as one id or none
stands on many, is cut by key, id and size, and rows equal in these are dealt out, as any order of them will do.

Sources rank by code point, null last; weights repeat along that order. Targets share the size of all
documents by weight, but stop at ``most`` times their source's size; the excess is shared anew by
weight among the others. That is solved in rising order of size over weight: a source is full if its cap is not above
its share of what the full ones before it leave. Ranks and running sums over sources are those of sorted ranges, so that a table
may have any number of sources. Documents of size 0 are taken 0 words; of a very long text its number of words is all that is
shuffled. Only id, text and source are read for the plan, whatever other columns are called. Rows that repeat an id share a key and are ordered by
size, so a rerun gives the same counts. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import SPACE, new_name, numbered, partitions, staged, whole
from txrisk.operators.ranges import with_running_total

WEIGHTS = (5, 2, 1)
MOST = 3
KEY_DIGITS = 15
CROWD = 65_536


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE[1:]}+")).cast("long")


def key_of(id_col: Column) -> Column:
    """60 uniform bits."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (unnamed, source, source_size)."""
    cycle = F.array(*map(F.lit, weights))
    by_name = [F.asc("unnamed"), F.asc("source")]
    rows = with_running_total(sizes, by_name, F.lit(1).cast("long"), "nth").withColumn(
        "weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")).cast("long")
    ).withColumn("cap", most * F.col("source_size")).withColumn("rise", F.col("cap") / F.col("weight"))
    rising = [F.asc("rise"), *by_name]
    rows = with_running_total(rows, rising, F.col("cap"), "cap_before")
    rows = with_running_total(rows, rising, F.col("weight"), "weight_before")
    # A row each: what all sources hold, then what the full ones leave to the others.
    sums = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    total, all_weight = sums.select("size").scalar(), sums.select("weight").scalar()
    rows = staged(rows.withColumn(
        "full", F.col("cap") * (all_weight - F.col("weight_before")) <= F.col("weight") * (total - F.col("cap_before"))
    ), "mix-sources")
    rest = rows.agg(
        (F.sum("source_size") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0))).alias("left"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).alias("shared"),
    )
    left, shared = rest.select("left").scalar(), rest.select("shared").scalar()
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * left).cast("double") / shared.cast("double")
    )
    return rows.select("unnamed", "source", "source_size", target.alias("target"))


def dealt(rows: DataFrame, shares: int) -> DataFrame:
    """Adds ``prefix``, the words before a row in its range, where rows equal in key, id and size are many."""
    same = ["unnamed", "source", "range", "key", "doc_id", "size", "share"]
    rows = rows.withColumn("share", F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int"))
    earlier = Window.partitionBy("unnamed", "source", "range").orderBy("key", "doc_id", "size", "share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    groups = rows.groupBy(*same).agg(F.sum("size").alias("group_size")).select(
        *(F.col(c).alias(f"{c}_") for c in same),
        F.coalesce(F.sum("group_size").over(earlier), F.lit(0)).alias("ahead"),
    )
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("row"))
    rows = rows.withColumn("nth", nth)
    equal = F.lit(True)
    for c in same:
        equal &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    return rows.join(groups, equal).withColumn("prefix", F.col("ahead") + (F.col("nth") - 1) * F.col("size")).drop(
        "share", "nth", "ahead", *(f"{c}_" for c in same)
    )


def mixed(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds source_size, target and taken to staged rows (row, doc_id, unnamed, source, size, key)."""
    ranges = 8 * partitions(rows.sparkSession)
    width = (1 << 4 * KEY_DIGITS) // ranges + 1
    rows = rows.withColumn("range", F.floor(F.col("key") / F.lit(width)).cast("int"))
    cells = rows.groupBy("unnamed", "source", "range").agg(F.sum("size").alias("cell_size"), F.count("*").alias("n"))
    cells = staged(cells, "mix-cells")
    sizes = cells.groupBy("unnamed", "source").agg(F.sum("cell_size").alias("source_size"))
    earlier = Window.partitionBy("unnamed", "source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("offset", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0))).join(
        targets(sizes, weights, most), ["unnamed", "source"]
    ).drop("cell_size", "n")
    within = Window.partitionBy("unnamed", "source", "range").orderBy("key", "doc_id", "size", "row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    place = ["unnamed", "source", "range"]
    held = cells.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    limit = max(CROWD, 4 * (held["total"] or 0) // ranges)
    crowded = None
    if (held["largest"] or 0) > limit:
        # At most a quarter as many as there are ranges.
        found = F.broadcast(staged(cells.filter(F.col("n") > limit).select(*place), "mix-crowded"))
        crowded = dealt(rows.join(found, place, "left_semi"), ranges).join(
            F.broadcast(offsets.join(found, place, "left_semi")), place
        )
        rows = rows.join(found, place, "left_anti")
    rows = rows.withColumn("prefix", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, place)
    if crowded is not None:
        rows = rows.unionByName(crowded)
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    last = F.greatest(F.lit(0), F.least(
        F.col("size"), budget - passes * F.col("source_size") - F.col("offset") - F.col("prefix")
    ))
    return rows.withColumn("passes", passes).withColumn("taken", passes * F.col("size") + last)


def keyed(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str) -> DataFrame:
    source = F.col(source_col)
    return staged(docs.select(
        row.alias("row"), F.col(id_col).alias("doc_id"), source.isNull().alias("unnamed"),
        whole(source).alias("source"), words(whole(text_col)).alias("size"), key_of(F.col(id_col)).alias("key"),
    ), "mix-rows")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and taken, repeats counted."""
    rows = keyed(docs, F.monotonically_increasing_id(), id_col, text_col, source_col)
    return mixed(rows, weights, most).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        length_col: str | None = "n_chars", weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row per pass over a document.

    Where a budget ends within a document, its last copy holds the words up to there, and
    ``length_col``, if there is one, that text's length.
    """
    docs, row = numbered(docs, "mix-docs")
    columns = [c for c in docs.columns if c != row]
    rows = keyed(docs, F.col(row), id_col, text_col, source_col)
    plan = mixed(rows, weights, most).filter(F.col("taken") > 0).select("row", "passes", "size", "taken")
    taken, cut, joined = (new_name(docs, c) for c in ("_taken", "_cut", "_mix_row"))
    # The words of each copy: all of them, or in the last one those that are left.
    last = F.col("taken") - F.col("passes") * F.col("size")
    copies = F.concat(
        F.array_repeat(F.col("size"), F.col("passes").cast("int")),
        F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<bigint>")),
    )
    plan = plan.select(F.col("row").alias(joined), F.col("size").alias(cut), F.explode(copies).alias(taken))
    frame = docs.join(plan, F.col(row) == F.col(joined))
    part = F.col(taken) < F.col(cut)
    content = whole(text_col)
    leading = F.when(content.rlike(f"^{SPACE}"), 1).otherwise(0)
    tail = F.element_at(F.split(content, f"{SPACE}+", (F.col(taken) + 1 + leading).cast("int")), -1)
    prefix = F.regexp_replace(F.left(content, F.length(content) - F.length(tail)), f"{SPACE}+$", "")
    text = F.when(part, prefix).otherwise(F.col(text_col))
    changed = {text_col: text}
    if length_col and length_col in columns:
        kind = docs.schema[length_col].dataType
        changed[length_col] = F.when(part, F.length(prefix).cast(kind)).otherwise(F.col(length_col))
    return frame.withColumns(changed).select(*columns)
