"""Secret scan with multipart credential linking.

Base kinds are reported wherever they match: assignments of a password, secret, token or key, access identifiers
and long hexadecimal strings. Weak kinds are parts that mean little alone: an account identifier
(``id``), a random-looking token (``key``) and an address (``endpoint``). They are reported only where
complementary parts occur within ``scope`` code points of each other in one text: an identifier with a
secret (a key, an assignment or a hexadecimal string), a key with an identifier (an id or an
access identifier), an endpoint with both. Weak parts that overlap a base span are left out.

Positions are code points, ends exclusive. Regular expressions give no positions in SQL, so each kind splits
its text at its matches: a match starts after the pieces and matches before it. Only texts that match are
split, and only matches, not texts, are shuffled. The interval join looks from each part to the nearest
part of either side in its text, in one sorted pass, so that many parts never meet in pairs.

A null text counts as empty; every row gives a row, repeated ids too; no rows give none. Spans that start at one place come
in the order of the kinds. Texts are searched whole; the spans of one text are sorted in one task, which may spill, and joined
to one value. Only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txrisk.llm.common import staged, whole

SCOPE = 200
LEAST_VALUE = 6

# Kinds in their order, with patterns. Shorter runs of the repeated classes in "access" and
# "hex" never pass their least length, so the length stands in the pattern.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
WEAK = {
    "id": (
        r"""(?i)(client_?id|access_?id|key_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9@+/_.-]{3,})"""
    ),
    "key": r"[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"""https?://[^\x20\x09-\x0D"'<>]+""",
}
KINDS = [*BASE, *WEAK]


def found(text: Column, kind: str) -> Column:
    """The matches in a text with the length of the piece before each; null where there is none."""
    pattern = (BASE | WEAK)[kind]
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), F.arrays_zip(gaps.alias("gap"), matches.alias("match")))


def candidates(matches: DataFrame) -> DataFrame:
    """One row per span: row, kind (its place in KINDS), start and end."""
    frames = []
    for rank, kind in enumerate(KINDS):
        frames.append(
            matches.filter(F.col(kind).isNotNull())
            .select("row", F.lit(rank).alias("kind"), F.posexplode(kind).alias("i", "found"))
            .select("row", "kind", "i", F.col("found.gap").alias("gap"), F.col("found.match").alias("match"))
            .filter(F.col("match").isNotNull())
        )
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("match")
    rows = rows.withColumn("end", F.sum(F.col("gap") + length).over(so_far)).withColumn(
        "start", F.col("end") - length
    )
    short = (F.col("kind") == KINDS.index("assign")) & (
        F.length(F.regexp_extract("match", ASSIGN, 2)) < LEAST_VALUE
    )
    plain = (F.col("kind") == KINDS.index("key")) & ~(
        F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Za-z]")
    )
    return rows.filter(~short & ~plain).select("row", "kind", "start", "end")


def linked(spans: DataFrame, scope: int) -> DataFrame:
    """Base spans, and the weak ones that are linked."""
    def is_one(*kinds: str) -> Column:
        return F.col("kind").isin([KINDS.index(k) for k in kinds])

    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    # What follows is what comes before in the reverse order: a growing frame is kept up row by row, a shrinking one is not.
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(part: Column, reach: int) -> Column:
        last = F.max(F.when(part, F.col("end"))).over(before)
        following = F.min(F.when(part, F.col("start"))).over(after)
        return F.coalesce(last > F.col("start") - reach, F.lit(False)) | F.coalesce(
            following < F.col("end") + reach, F.lit(False)
        )

    base = is_one(*BASE)
    spans = spans.withColumn("covered", near(base, 0)).filter(base | ~F.col("covered"))
    spans = spans.withColumn("by_id", near(is_one("id", "access"), scope + 1)).withColumn(
        "by_secret", near(is_one("key", "assign", "hex"), scope + 1)
    )
    return spans.filter(
        base
        | (is_one("id") & F.col("by_secret"))
        | (is_one("key") & F.col("by_id"))
        | (is_one("endpoint") & F.col("by_id") & F.col("by_secret"))
    ).select("row", "kind", "start", "end")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: row, doc_id and ``spans``, an array of (start, kind, end) by start and kind."""
    text = whole(text_col)
    matches = staged(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        *(found(text, kind).alias(kind) for kind in KINDS),
    ), "secret-matches")
    spans = linked(candidates(matches), scope).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return matches.select("row", "doc_id").join(spans, "row", "left").withColumn(
        "spans", F.coalesce("spans", empty)
    )


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text."""
    kinds = F.array(*map(F.lit, KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        )), ",")

    def count(kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == rank)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return secret_spans(docs, id_col, text_col, scope).select(
        "doc_id", *map(count, BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
