import hashlib
import re

import pytest

from llm_helpers import awkward, documents, prose
from txrisk.llm import exact_dedup
from txrisk.llm.exact_dedup import OpenTable


def plain(rows):
    normal = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, t in normal.items():
        groups.setdefault(t, []).append(i)
    return sorted(
        (i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        for i, t in normal.items()
    )


def test_awkward_texts(spark):
    texts = awkward() + awkward()
    found = exact_dedup.exact_dedup(documents(spark, texts).repartition(3))
    assert sorted(map(tuple, found.collect())) == plain(list(enumerate(texts, 1)))


def test_large_buckets_are_partitioned_again(spark):
    texts = [prose(40, i % 150) for i in range(400)]
    found = exact_dedup.assign(documents(spark, texts), bucket_bytes=2_000)
    found = found.selectExpr("id", "keep_id", "group_size", "row = keep_row", "text_sha256")
    assert sorted(map(tuple, found.collect())) == plain(list(enumerate(texts, 1)))


def test_tables_are_flushed(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(exact_dedup, "TABLE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({
        "row": list(range(6)), "id": [5, 4, 3, 2, 1, None], "h": [9] * 6, "text": ["aaaaaa", "b", "b", "cccccc", "b", "b"],
    })
    parts = [r for b in exact_dedup.collapse(iter([batch])) for r in b.to_pylist()]
    assert [r["rep"] for r in parts] == [0, 1, 1, 3, 4, 4]
    assert [(r["n"], r["first_id"]) for r in parts if r["n"]] == [(1, 5), (2, 3), (1, 2), (2, 1)]


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (None, "a", 2), (None, "b", 3)], "doc_id long, text string, x int")
    found = exact_dedup.exact_dedup(docs).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in found) == [
        (0, 0, 1, True), (0, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True),
    ]
    assert sorted(r.text for r in exact_dedup.without_copies(docs).collect()) == ["a", "b"]


def test_empty(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert exact_dedup.without_copies(docs).columns == docs.columns


def test_open_table_compares_contents():
    held = OpenTable()
    numbers = [held.place(7, str(i).encode()) for i in range(2000)]
    assert numbers == list(range(2000))
    assert held.place(7, b"1999") == 1999
    assert held.place(8, b"1999") == 2000
