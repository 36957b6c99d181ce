"""Line deduplication by content-defined chunks.

A text is its lines, split at ``\\n``. Each line has a hash; a rolling hash over ``span`` line hashes ends
a chunk wherever it is divisible by ``divisor``, or where the text ends. As boundaries depend on the
last few lines only, inserted lines shift none of the later ones: a shared passage is chunked alike
in every text, but for its edges. A chunk of two lines or more that holds any word and occurs again is
removed wherever it isn't its first occurrence (smallest id, null ids last; then text hash and chunk number). A text's lines before its first full window are chunked with a shorter one.
In a run of one line the rolling hash is constant, so the run is cut at each line or nowhere: it stays, unless
a chunk that holds the whole run, or its end, occurs again.

``least`` and ``most`` change that; the registered query uses neither. With ``least``, a boundary counts only if none of the
``least`` - 1 lines before would have one, and if so many lines are left on both sides within the text, so that no
chunk is shorter and copies of a text of so many lines lose them all. With ``most``, a chunk is cut after each ``most`` lines,
the last part taking what is left over: a run of one line becomes equal chunks, of which the first stays.

Occurrences are counted by chunk hash first; only chunks whose hash repeats are shuffled with their
text, and these are grouped by the text itself, so equal hashes of different texts remove nothing. Both
aggregations combine before their shuffle; the join of occurrences with their first is one that
adaptive execution splits for a hot chunk.

The only shuffles with text are those of the repeated chunks and one of the documents, to take chunks out.

A null text counts as empty and stays one empty line; an empty table gives no rows. A document is its id and text:
rows that repeat both are the same document and are treated alike. Of rows that repeat an id only, any
may hold the first occurrence, by the hash of the text. Only id and text are read, whatever other columns are called. Work and
memory are linear in a text's lines; one task holds a text with its lines and their hashes, so some five times the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import staged, whole

SPAN = 3
DIVISOR = 4
MODULUS = 1_000_003
BASE = 131_071
BREAK = "\n"


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long") % MODULUS


def once(value: Column) -> Column:
    """The value by way of a generator, so that it is worked out once and not within every lambda that uses it."""
    return F.explode(F.array(value))


def rolling(hashes: Column, span: int) -> Column:
    """At each line, the polynomial hash of it and the ``span`` - 1 lines before."""
    def earlier(lines: int) -> Column:
        none = F.array_repeat(F.lit(0).cast("long"), lines)
        return F.slice(F.concat(none, hashes), F.lit(1), F.size(hashes))

    value = earlier(span - 1)
    for back in range(span - 2, -1, -1):
        value = F.zip_with(value, earlier(back), lambda v, h: (v * BASE + h) % MODULUS)
    return value


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def spaced(hits: Column, least: int) -> Column:
    """Those hits with none among the ``least`` - 1 places before."""
    settled = hits
    for back in range(1, least):
        earlier = F.slice(F.concat(F.array_repeat(F.lit(False), back), hits), F.lit(1), F.size(hits))
        settled = F.zip_with(settled, earlier, lambda hit, before: hit & ~before)
    return settled


def chunked(docs: DataFrame, span: int, divisor: int, least: int = 1, most: int | None = None) -> DataFrame:
    """One row per chunk: doc_id, text_hash, chunk (from 0), start line, number of lines and text."""
    rows = docs.select("doc_id", "text_hash", once(F.split("text", BREAK, -1)).alias("lines"))
    rows = rows.select("*", once(F.transform("lines", line_hash)).alias("hashes"))
    if least > 1:
        hits = F.transform(rolling(F.col("hashes"), span), lambda r: r % divisor == 0)
        rows = rows.select("doc_id", "text_hash", "lines", once(hits).alias("hits"))
        inside = lambda i: (i + 1 >= least) & (F.size("lines") - i - 1 >= least)
        breaks = F.transform(spaced(F.col("hits"), least), lambda hit, i: F.when(hit & inside(i), i + 1))
    else:
        breaks = F.transform(rolling(F.col("hashes"), span), lambda r, i: F.when(r % divisor == 0, i + 1))
    ends = F.array_distinct(F.concat(F.filter(breaks, lambda e: e.isNotNull()), F.array(F.size("lines"))))
    rows = rows.select("doc_id", "text_hash", "lines", once(ends).alias("ends"))
    rows = rows.select("*", F.posexplode("ends").alias("chunk", "end"))
    start = F.when(F.col("chunk") > 0, F.get("ends", F.col("chunk") - 1)).otherwise(0)
    rows = rows.withColumn("start", start).withColumn("n", F.col("end") - F.col("start"))
    if most is not None:
        # The number of a part within its chunk; parts are told apart and ordered by the line they start at.
        parts = F.greatest(F.lit(1), F.floor(F.col("n") / most).cast("int"))
        rows = rows.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        last = F.col("part") == F.col("parts") - 1
        rows = rows.withColumn("start", F.col("start") + F.col("part") * most)
        rows = rows.withColumn("n", F.when(last, F.col("end") - F.col("start")).otherwise(most))
        rows = rows.withColumn("chunk", F.col("start"))
    return rows.select(
        "doc_id", "text_hash", "chunk", "start", "n",
        F.array_join(F.slice("lines", F.col("start") + 1, F.col("n")), BREAK).alias("chunk_text"),
    )


def removals(chunks: DataFrame) -> DataFrame:
    """The chunks that go: doc_id, text_hash, start, n."""
    several = chunks.filter((F.col("n") > 1) & F.col("chunk_text").rlike(r"[^\x20\x09-\x0D]")).withColumn(
        "h", F.xxhash64("chunk_text")
    )
    repeated = several.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h")
    # Written, as both sides of the next join need them, and their shuffle carries all chunks.
    several = staged(several.join(repeated, "h", "left_semi"), "line-repeated")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "chunk")
    firsts = several.groupBy("h", "chunk_text").agg(F.min(place).alias("first"))
    return several.withColumn("place", place).join(firsts, ["h", "chunk_text"]).filter(
        F.col("place") != F.col("first")
    ).select("doc_id", "text_hash", "start", "n").distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
               divisor: int = DIVISOR, least: int = 1, most: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_chunks_removed and the text that is left."""
    docs = named(docs, id_col, text_col)
    gone = removals(chunked(docs, span, divisor, least, most)).groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("n") - 1))).alias("gone"),
        F.sum("n").alias("n_removed"), F.count("*").alias("n_chunks_removed"),
    ).withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"})
    frame = docs.join(
        gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left"
    )
    frame = frame.select(
        "doc_id", "n_removed", "n_chunks_removed", "gone", "text", once(F.split("text", BREAK, -1)).alias("lines")
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), BREAK)
    return frame.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_chunks_removed", F.lit(0)).cast("long").alias("n_chunks_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
