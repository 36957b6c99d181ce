import glob
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import awkward
from txrisk.llm import phrases
from txrisk.llm.common import SHUFFLE_CLEANUP, shuffles_deleted, staged
from txrisk.llm.phrases import collocations

DOCS = "doc_id long, text string, lang string, block long, code int, n long, gid long, phrase string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, 1, 2, 3, 4, "x") for i, (lang, text) in enumerate(rows)], DOCS)


def plain(rows, least, longest=5, share=100, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = any(
            f[lang, q] * 100 >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for other, q in f if other == lang and len(q) > len(p) and f[lang, q] >= least
        )
        if inside:
            continue
        score, _, l, r = min(
            (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        )
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, rows in found.items() for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def drawn(seed, n):
    draw = random.Random(seed)
    vocabulary = ["An", "be", "CO", "du", "él", "zz", "\x01", "日本"]
    rows = []
    for _ in range(n):
        text = "".join(
            draw.choice(["be co du el", "an an an", draw.choice(vocabulary)]) + draw.choice([" "] * 9 + [". ", "\t", "\n", "?!", "  "])
            for _ in range(draw.randint(0, 40))
        )
        rows.append((draw.choice(["x", "x", "y", None, ""]), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_same_as_plain(spark, seed):
    rows = drawn(seed, 60)
    found = collocations(table(spark, rows).repartition(4), least=4)
    assert sorted(map(tuple, found.collect())) == plain(rows, 4)


def test_small_blocks_parameters_and_best(spark):
    rows = drawn(9, 50)
    found = collocations(table(spark, rows).repartition(20), least=3, longest=4, share=60, top=5)
    assert sorted(map(tuple, found.collect())) == plain(rows, 3, longest=4, share=60, top=5)


def test_blocks_end_early_and_long_texts_are_read_in_parts(monkeypatch):
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(phrases, "TaskContext", Task)
    text = "a b. c  d\te,, f " * 40
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["x"] * 3), pa.array([text.encode(), None, text.encode()], pa.binary())], names=["lang", "text"]
    )

    def codes():
        rows = [r for b in phrases.read_blocks(iter([batch])) for r in b.to_pylist()]
        return [(r["block"], phrases.unpacked(r["data"])[0].tolist()) for r in rows if r["code"] == 0]

    whole = codes()
    assert [b for b, _ in whole] == [3 << 11]
    monkeypatch.setattr(phrases, "TEXT_BYTES", 5)
    assert codes() == whole
    monkeypatch.setattr(phrases, "BLOCK", 10)
    assert [b for b, _ in codes()] == [3 << 11, (3 << 11) + 1]


def test_scores_beyond_64_bits(spark):
    """Counts as of a corpus of 10 to the 13 words: products take 30 digits."""
    found = spark.createDataFrame(
        [([10**11], [10**10 + 1], 10**10, 10**13)], "firsts array<long>, rests array<long>, a long, n long"
    ).select(phrases.weakest_cut(2).alias("c")).collect()[0].c
    assert found.score == 1000 * 10**10 * 10**13 // (10**11 * (10**10 + 1))


def test_awkward_texts(spark):
    rows = [(lang, text) for text in awkward() for lang in ("x", None)] * 2
    assert collocations(table(spark, rows), least=30).count() > 0
    texts = [(lang, text) for lang, text in rows if text is None or len(text) < 5000]
    assert sorted(map(tuple, collocations(table(spark, texts), least=3).collect())) == plain(texts, 3)


def test_nothing_frequent_and_no_rows(spark):
    docs = table(spark, [("x", "a b c"), (None, None)])
    assert collocations(docs).count() == 0
    assert collocations(docs.limit(0)).count() == 0


def test_pairs_come_in_short_rows_of_one_bucket():
    """Rows bound what is read at once; numbers go on over them, as they are places of groups."""
    random_codes = np.random.default_rng(5).integers(0, 301, 200_000).astype(np.int32)
    ids = np.sort(np.random.default_rng(6).choice(1 << 50, 300, replace=False))
    rows = phrases.merge_joined(9, random_codes, ids, 3).to_pylist()
    assert max(len(r["lefts"]) for r in rows) == phrases.PAIRS_OF_ROW
    assert {len(r[c]) - len(r["lefts"]) for r in rows for c in ("rights", "ns")} == {0}
    assert {r["bucket"] for r in rows} == {0, 1, 2} and len(rows) > 3
    found, at = Counter(), 0
    for r in rows:
        assert (r["block"], r["base"]) == (9, at)
        at += len(r["lefts"])
        lefts, rights = np.array(r["lefts"]), np.array(r["rights"])
        assert (phrases.bucket_of(lefts, rights, 3) == r["bucket"]).all()
        found.update(dict(zip(zip(r["lefts"], r["rights"], strict=True), r["ns"], strict=True)))
    codes = random_codes.tolist()
    wanted = Counter((ids[a - 1], ids[b - 1]) for a, b in zip(codes, codes[1:], strict=False) if a and b)
    assert at == len(found) and found == wanted


def test_pairs_are_counted_from_packed_rows():
    """Blocks in any order, a pair in many blocks: the smallest place is the id; packed, a pair takes far less than its 24 bytes."""
    ids = np.sort(np.random.default_rng(6).choice(1 << 40, 300, replace=False))
    wanted, places, members = Counter(), {}, {}
    rows = []
    for block in (9, 2, 5):
        codes = np.random.default_rng(block).integers(0, 301, 30_000).astype(np.int32)
        batch = phrases.merge_joined(block, codes, ids, 1)
        assert {len(batch.column("lefts")[0].as_py())} == {phrases.PAIRS_OF_ROW}
        at = 0
        for r in batch.to_pylist():
            for pair, n in zip(zip(r["lefts"], r["rights"], strict=True), r["ns"], strict=True):
                wanted[pair] += n
                place = (block << phrases.PLACE_BITS) + at
                places[pair] = min(place, places.get(pair, place))
                members.setdefault(pair, []).append((block, place))
                at += 1
        rows.append(phrases.packed_rows(batch))
    assert sum(len(d) for b in rows for d in b.column("data").to_pylist()) < 12 * sum(map(len, members.values()))
    found = phrases.count_pairs(pa.Table.from_batches(rows)).to_pylist()
    assert sorted(map(tuple, (r.values() for r in found))) == sorted(
        (block, *pair, places[pair], place == places[pair], a) for pair, a in wanted.items() for block, place in members[pair]
    )


def test_members_are_packed_by_block(monkeypatch):
    """A few rows go to each block, not one for each of its members."""
    monkeypatch.setattr(phrases, "HELD", 7000)
    draw, n = np.random.default_rng(3), 20_000
    ids = np.sort(draw.choice(1 << 40, 500, replace=False))
    pairs = draw.permutation(5 * 500 * 500)[:n]
    columns = {"block": pairs % 5 << 11, "left": ids[pairs // 5 % 500], "right": ids[pairs // 2500], "gid": draw.choice(ids, n)}
    rows = [r for b in phrases.packed_members(iter(pa.table(columns).to_batches(3000))) for r in b.to_pylist()]
    assert len(rows) == 5 * 3 and sum(len(r["data"]) for r in rows) < 16 * n
    found = [(r["of_block"], *m) for r in rows for m in zip(*phrases.unpacked_pairs(r["data"]).tolist(), strict=True)]
    assert sorted(found) == sorted(zip(*(c.tolist() for c in columns.values()), strict=True))
    assert list(phrases.packed_members(iter([]))) == []


def test_words_are_deleted_before_phrases_grow(spark, monkeypatch):
    """A relation that grows has its occurrences alone, and the shuffles behind what is staged are deleted with each write."""
    steps, real = [], phrases.staged_at

    def watched(rows, purpose, **options):
        steps.append((purpose, rows.columns, spark.conf.get(SHUFFLE_CLEANUP, None)))
        found = real(rows, purpose, **options)
        steps.append(found[1])
        return found

    def grow(*args, real=phrases.grow):
        steps.append(glob.glob(steps[1]))
        return real(*args)

    monkeypatch.setattr(phrases, "staged_at", watched)
    monkeypatch.setattr(phrases, "grow", grow)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = drawn(4, 30)
    assert sorted(map(tuple, collocations(table(spark, rows), least=3).collect())) == plain(rows, 3)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert [s[:2] for s in steps if isinstance(s, tuple) and s[0] == "phrases-1"] == [("phrases-1", ["block", "data"])]
    assert {s[2] for s in steps if isinstance(s, tuple)} == {"true"}
    assert [s for s in steps if isinstance(s, list)] == [[]] * 4


def test_shuffles_are_deleted_with_their_write(spark):
    folders = [str(f) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*")}

    before, until = files(), time.time() + 30
    with shuffles_deleted(spark):
        assert staged(spark.range(1000).repartition(7, "id"), "test").count() == 1000
        while files() - before and time.time() < until:
            time.sleep(0.1)
    assert not files() - before
