import itertools
import os
import random

import numpy as np
import pytest
import xxhash

from llm_helpers import awkward, documents, prose, words
from txrisk.llm import simhash
from txrisk.llm.simhash import simhash_groups, without_near_copies

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plain_print(text, n=3):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    parts = words(low)
    shingles = [" ".join(parts[i:i + n]) for i in range(len(parts) - n + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """prints: {id: print}; {id: smallest id reachable}, by looking at all pairs."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in np.nonzero(np.bitwise_count(values ^ values[a]) <= distance)[0]:
            x, y = find(a), find(int(b))
            root[max(x, y)] = min(x, y)
    return {i: ids[find(a)] for a, i in enumerate(ids)}


def check(found, texts):
    prints = {i: plain_print(t) for i, t in texts.items()}
    of = plain_components(prints)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{p:016x}", of[i]) for i, p in prints.items()
    }
    assert len(found) == len(texts)


def test_awkward_texts(spark):
    texts = awkward() + ["A B c", "a b C", "a b", "À b c", "à b c"]
    check(simhash_groups(documents(spark, texts).repartition(3)).collect(), dict(enumerate(texts, 1)))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(simhash_groups(docs).collect(), {r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("shard", [16, 4096])
def test_links_are_those_of_all_pairs(spark, monkeypatch, shard):
    """Chains, balls around a point, and noise, with trees cut deep or not at all."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "SMALL", 8)
    draw = random.Random(shard)
    prints = {draw.getrandbits(64) for _ in range(400)}
    for centre in [draw.getrandbits(64) for _ in range(20)]:
        for _ in range(25):
            centre ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4)))
            prints.add(centre)
    ball = draw.getrandbits(64)
    prints |= {ball ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(0, 64, 2), 2)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, 3)).collect()}
    expected = plain_components({p: p & (1 << 64) - 1 for p in signed})
    assert {p: roots.get(p, p) for p in signed} == expected


def test_one_of_each_group_stays(spark):
    base = prose(6000, 1)
    texts = [base, base + " x", prose(300, 2), base, None, ""]
    docs = documents(spark, texts)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    of = plain_components({i: plain_print(t) for i, t in enumerate(texts, 1)})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(of.values()))
    assert of[4] == 1 and of[6] == 5


def test_repeated_null_and_no_ids(spark):
    docs = spark.createDataFrame([(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "p q r s")], "doc_id long, text string")
    found = simhash_groups(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 4), (4, 4), (4, 4)]
    assert without_near_copies(docs).count() == 2
    assert simhash_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 24, 1000])
def test_long_chains_take_few_rounds(spark, monkeypatch, n):
    """A chain of links collapses by pointer jumping: rounds grow with the logarithm of its length."""
    rounds = []
    inner = simhash.staged

    def counted(rows, purpose):
        rounds.append(purpose)
        return inner(rows, purpose)

    monkeypatch.setattr(simhash, "staged", counted)
    order = list(range(n + 1))
    for names in (order, random.Random(n).sample(order, n + 1)):
        rounds.clear()
        links = [(names[i], names[i + 1]) for i in range(n)]
        edges = spark.createDataFrame([(max(e), min(e)) for e in links], "a long, b long")
        found = {r.node: r.root for r in simhash.components(edges).collect()}
        assert found == dict.fromkeys(order, 0)
        assert rounds.count("simhash-merge") <= 8 and rounds.count("simhash-jump") <= 20
