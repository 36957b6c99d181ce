"""The pipeline against plain versions of its stages, each judged on its own input."""

import os
import re
from collections import defaultdict

import numpy as np

import corpus_pipeline
from llm_helpers import words
from test_simhash import plain_components, plain_print
from txrisk.llm.common import staged, table
from txrisk.llm.packing import encoder_of
from txrisk.llm.quality import quality_grades

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    outputs = []
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        given = staged(stage(spark, given, SF), f"test-{name}")
        outputs.append(given)
    graded, exact, near, mixed, packed = outputs
    assert all(o.columns == columns for o in outputs[:-1])

    kept = {r.doc_id for r in quality_grades(docs, table(spark, SF, "labels")).collect() if r.kept}
    assert set(rows(graded)) == kept and 0 < len(kept) < docs.count()

    first = {}
    for key, r in sorted(rows(graded).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r.text or ""), key)
    assert set(rows(exact)) == set(first.values())

    component = plain_components({k: plain_print(r.text) for k, r in rows(exact).items()})
    assert set(rows(near)) == set(component.values())

    sizes, taken = defaultdict(int), defaultdict(int)
    for r in near.collect():
        sizes[r.source] += len(words(r.text))
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
        assert rows_text(near)[r.doc_id].startswith(r.text)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len(sizes)
    assert all(taken[s] <= 3 * sizes[s] for s in sizes)

    copies = [r for r in mixed.collect()]
    lengths = sum(len(encoder_of(None).tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in copies)
    pieces = packed.collect()
    assert sum(r.length for r in pieces) == lengths
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


TEXTS = {}


def rows_text(frame):
    if not TEXTS:
        TEXTS.update({r.doc_id: r.text for r in frame.collect()})
    return TEXTS


def test_empty_table(spark):
    given = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        given = staged(stage(spark, given, SF), f"empty-{name}")
        assert given.count() == 0


def test_a_run_leaves_its_last_rows_only(spark, tmp_path, monkeypatch):
    """What stages had staged is gone when the run ends, but not what others have, and the result can be read twice."""
    from txrisk.llm import common

    def work_dir(session, purpose):
        folder = tmp_path / f"{purpose}-{len(list(tmp_path.iterdir()))}-{len(made)}"
        made.append(folder)
        return str(folder)

    made = []
    monkeypatch.setattr(common, "work_dir", work_dir)
    other = staged(spark.range(3), "other")
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert packed.count() == len(packed.collect()) > 0 and other.count() == 3
    assert len(made) > 8
    assert sorted(f.name.split("-")[0] for f in tmp_path.iterdir()) == ["other", "pipeline"]
    assert common._STAGED.get() is None
