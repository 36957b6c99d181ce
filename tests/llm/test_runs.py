import os
import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm_helpers import awkward, documents, words
from txrisk.llm import runs
from txrisk.llm.queries import echoed, op12_periodic_runs
from txrisk.llm.runs import kept_words, periodic_runs, runs_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plain_runs(w):
    """All periods, each over all words."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, e - a, q) for (a, e), q in found.items())


def plain_kept(w, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def numbers(w):
    return np.array(w, np.int32)


@pytest.mark.parametrize("appended", [1, 2, 7, 64, 1 << 18])
def test_same_as_plain(monkeypatch, appended):
    monkeypatch.setattr(runs, "APPENDED", appended)
    draw = random.Random(appended)

    def text():
        letters, w = draw.choice([1, 2, 2, 3, 5]), []
        for _ in range(draw.randint(0, 6)):
            part = [draw.randrange(letters) for _ in range(draw.randint(1, draw.choice([2, 4, 9, 17, 40])))]
            w += part if draw.random() < 0.4 else (part * 10)[:int(len(part) * draw.uniform(2, 9))]
        return w

    for _ in range(150):
        texts = [text() for _ in range(draw.randint(1, 5))]
        assert runs_of([numbers(w) for w in texts]) == [plain_runs(w) for w in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_two_words_only(w):
    found = runs_of([numbers(w)])[0]
    assert found == plain_runs(w)
    assert [x for x, k in zip(w, kept_words(len(w), found)) if k] == plain_kept(w, found)


def test_long_periods_and_long_runs():
    assert runs_of([np.zeros(500_000, np.int32)]) == [[(0, 500_000, 1)]]
    assert runs_of([np.tile(np.arange(50_001, dtype=np.int32), 5)]) == [[(0, 250_005, 50_001)]]
    assert runs_of([np.arange(300_000, dtype=np.int32)]) == [[]]


def test_words_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", 7)
    text = "a bb  ccc\n dddddddddddddddddddd\te\x0bf\x0c \r g\xa0h " * 5
    found = runs.WordNumbers()
    ids = found.of_text(memoryview(text.encode()))
    assert [list(found)[i].decode() for i in ids] == words(text)


def test_awkward_texts_and_columns(spark):
    texts = awkward() + ["a b " * 10, "x " * 6, "x " * 5, "p q r " * 4 + "p q", "z a a a a a a a z"]
    docs = documents(spark, texts).withColumnsRenamed({"h": "runs", "kept": "Collapsed"})
    found = {r.doc_id: r for r in periodic_runs(docs).collect()}
    for number, text in enumerate(texts, 1):
        w = words(text)
        expected = plain_runs(w) if len(w) < 1000 else []
        row = found[number]
        assert row.n_words == len(w) and [tuple(r) for r in row.runs] == expected
        assert row.collapsed == " ".join(plain_kept(w, expected))


def test_a_text_of_megabytes(spark):
    text = " ".join(f"w{i % 1000}" for i in range(600_000))
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in row.runs] == [(0, 600_000, 1000)]
    assert row.collapsed == " ".join(f"w{i}" for i in range(1000))


def test_repeated_ids_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "a " * 8), (1, "a " * 8), (None, "a " * 9), (None, None)], "doc_id long, text string")
    found = periodic_runs(docs).collect()
    assert sorted((r.doc_id or 0, len(r.runs), r.n_words) for r in found) == [(0, 0, 0), (0, 1, 9), (1, 1, 8), (1, 1, 8)]
    assert periodic_runs(docs.limit(0)).count() == 0


def plain_echo(key, w):
    h = crc32(str(key).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op12_periodic_runs(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        w = plain_echo(r.doc_id, words(texts[r.doc_id]))
        assert echoed(r.doc_id, np.arange(len(w))).tolist() == plain_echo(r.doc_id, list(range(len(w))))
        if len(w) > 700:
            continue
        expected = plain_runs(w)
        assert r.n_runs == len(expected)
        best = max(expected, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if expected else None)
        assert r.runs_sha256 == sha256("".join(f"{a},{n},{q}\n" for a, n, q in expected).encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(" ".join(plain_kept(w, expected)).encode()).hexdigest()
