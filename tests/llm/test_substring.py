import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import awkward, documents, prose, words
from txrisk.llm import substring
from txrisk.llm.substring import substring_dedup

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plain(rows, window=20):
    seen, found = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        parts = words(text)
        keep = [True] * len(parts)
        for i in range(len(parts) - window + 1):
            now = tuple(parts[i:i + window])
            if now in seen:
                keep[i:i + window] = [False] * window
            seen.add(now)
        left = " ".join(w for w, k in zip(parts, keep, strict=True) if k)
        found.append((key, len(parts), keep.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return found


def check(spark, texts, **settings):
    found = sorted(map(tuple, substring_dedup(documents(spark, texts).repartition(4), **settings).collect()))
    expected = plain(list(enumerate(texts, 1)))
    assert found == expected
    return expected


def shared(n, common, first=0):
    """Texts with one passage at different places."""
    return [prose(5 + i % 37, 7000 + first + i) + " " + common + " " + prose(30 + i % 11, 9000 + first + i) for i in range(n)]


def test_awkward_texts(spark):
    texts = awkward() + ["a " * 300, "a b " * 100, "a b c d e f g " * 40, prose(60, 8) + "\n" + prose(60, 8)]
    assert any(r[2] for r in check(spark, texts))


def test_passages(spark):
    texts = shared(30, prose(60, 11)) + shared(30, prose(21, 12), 100) + [prose(80, 13)] * 9
    check(spark, texts)


@pytest.mark.parametrize("held,local", [(50, 1), (32 << 20, 1), (32 << 20, 10_000)])
def test_common_grams_and_crowds(spark, monkeypatch, held, local):
    """A short common line within many contexts, and copies, beyond the crowd a bucket takes."""
    monkeypatch.setattr(substring, "HELD_BYTES", held)
    monkeypatch.setattr(substring, "LOCAL", local)
    monkeypatch.setattr(substring, "LEAST_COMMON", 6)
    texts = shared(40, prose(12, 14)) + shared(20, prose(40, 15), 100) + [prose(50, 16)] * 30 + ["k " * 80] * 5
    check(spark, texts, crowd=4)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, substring_dedup(docs).collect())) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_null_and_no_ids(spark):
    text = prose(30, 1)
    docs = spark.createDataFrame([(2, text), (2, text), (None, text), (None, None)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup(docs).collect())
    assert found == [(0, 0, 0), (0, 30, 30), (2, 30, 0), (2, 30, 30)]
    assert substring_dedup(docs.limit(0)).count() == 0


def test_minimisers_of_rows_that_share_an_id_are_not_gathered(spark):
    common = np.zeros(0, np.uint64)
    texts = [prose(30, i % 40) for i in range(80)]
    alone = documents(spark, texts).selectExpr("doc_id", "cast(text as binary) as text")
    shared = alone.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, 7).cast("long"))

    def most(docs):
        sizes = substring.repeated_minimisers(docs, 20, 8, common).select(F.max(F.size("hs"))).first()
        return sizes[0]

    assert most(shared) == most(alone) > 0
    got = sorted(r.n_removed for r in substring_dedup(shared).collect())
    assert got == sorted(r.n_removed for r in substring_dedup(alone).collect())


def test_long_runs_of_windows_are_cut(spark):
    line = prose(7, 21)
    texts = ["k " * 3000, "x k " + "k " * 700 + "y", " ".join([line] * 500), prose(3, 22) + " " + " ".join([line] * 90)]
    assert any(r[2] for r in check(spark, texts))


def test_blocks_change_no_hash_and_no_row(spark, monkeypatch):
    texts = [t.encode() for t in (*(a or "" for a in awkward()), "é\x0b" * 90, " \t" + prose(40, 23) + "\n ")]
    hashed = substring.Grams(np.zeros(0, np.uint64))
    whole = [hashed(t, 8).tolist() for t in texts]
    for size in (1, 5, 64, 1000):
        monkeypatch.setattr(substring, "BLOCK_BYTES", size)
        hashed = substring.Grams(np.zeros(0, np.uint64))
        assert [hashed(t, 8).tolist() for t in texts[-8:]] == whole[-8:]
    for t in texts:
        parts, found = t.split(), substring.Words(t)
        assert found.text == b" ".join(parts) and len(found) == len(parts)
        if parts:
            assert found.part(0, len(parts)) == found.text and found.part(len(parts) - 1, len(parts)) == parts[-1]


def test_words_outside_overlapping_spans():
    words = substring.Words(b" a b  c d\te f ")
    assert words.without([]) == (b"a b c d e f", 0)
    assert words.without([(4, 5), (1, 3), (2, 3)]) == (b"a d f", 3)
    assert words.without([(0, 6), (2, 4)]) == (b"", 6)


def test_chosen_places_are_those_of_the_smallest_of_a_window():
    numbers = np.random.default_rng(5)
    for width in (1, 5, 8, 13):
        grams = numbers.integers(0, 9, 40).astype(np.uint64)
        least = [grams[i:i + width].min() for i in range(len(grams) - width + 1)]
        expected = [
            int(g) for q, g in enumerate(grams) if any(least[w] == g for w in range(max(0, q - width + 1), min(q + 1, len(least))))
        ]
        assert substring.chosen(grams, width).tolist() == expected


def test_texts_of_megabytes(spark):
    """One of 8 MB, one that holds its second half, one word of 3 MB."""
    long = " ".join(f"w{i * 7919 % 1_000_003}" for i in range(1_000_000))
    half = long[len(long) // 2:].split(" ", 1)[1]
    found = {r.doc_id: r for r in substring_dedup(documents(spark, [long, half, "y" * 3_000_000])).collect()}
    n = len(half.split())
    assert [(found[i].n_words, found[i].n_removed) for i in (1, 2, 3)] == [(1_000_000, 0), (n, n), (1, 0)]


def test_memory_of_a_worker_for_one_long_text():
    """Bytes held at once while a text of 20 MB is hashed and its words are found, by those of the text."""
    import tracemalloc

    text = b"word and more " * 1_500_000
    hashed = substring.Grams(np.zeros(0, np.uint64))
    tracemalloc.start()
    substring.runs(hashed(text, 8), 13)
    hashing = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    substring.Words(text)
    finding = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert max(hashing, finding) < 16 * len(text)
