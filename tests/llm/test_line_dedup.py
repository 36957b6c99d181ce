import re
from hashlib import md5

import pytest

from llm_helpers import awkward, documents, prose
from txrisk.llm.line_dedup import line_dedup


def lines(n, seed):
    return [prose(6, 1000 * seed + i) for i in range(n)]


def test_shared_passage_goes_though_lines_shift(spark):
    passage = lines(400, 1)
    first, second = lines(10, 2) + passage + lines(10, 3), lines(23, 4) + passage + lines(5, 5)
    found = {r.doc_id: r for r in line_dedup(documents(spark, ["\n".join(first), "\n".join(second)])).collect()}
    assert found[1].text == "\n".join(first) and found[1].n_removed == 0
    left = found[2].text.split("\n")
    assert len(left) + found[2].n_removed == len(second) == found[2].n_lines
    # All but the chunks at its edges and those of one line (one line in sixteen).
    assert found[2].n_removed > 340
    assert [x for x in second if x not in passage] == [x for x in left if x not in passage]


def test_single_repeated_lines_stay(spark):
    texts = ["\n".join([prose(5, i), "same line", prose(5, i + 100)]) for i in range(20)]
    found = line_dedup(documents(spark, texts)).collect()
    assert {r.doc_id: r.text for r in found} == dict(enumerate(texts, 1))


def test_hot_chunk(spark):
    passage = "\n".join(lines(12, 9))
    found = line_dedup(documents(spark, [passage] * 300).repartition(6)).collect()
    assert {r.doc_id for r in found if r.n_removed} == set(range(2, 301))


def test_awkward_texts(spark):
    texts = awkward()
    found = {r.doc_id: r for r in line_dedup(documents(spark, texts)).collect()}
    assert {i: r.text for i, r in found.items()} == {i: t or "" for i, t in enumerate(texts, 1)}
    assert line_dedup(documents(spark, ["a"]).limit(0)).count() == 0


def test_repeated_rows(spark):
    text = "\n".join(lines(30, 6))
    rows = [(3, text), (3, text), (None, text), (3, text + "\nx"), (4, text)]
    found = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    # Rows that repeat id and text are one document; of the two texts of id 3, one holds the first occurrences.
    assert all(r.n_removed > 0 for r in found if r.doc_id != 3)
    assert {r.n_removed > 0 for r in found if r.doc_id == 3} == {False, True}


def plain(texts, span=3, divisor=4, least=1, most=None):
    """What stays of each text, document after document."""
    seen, found = set(), []
    for text in texts:
        rows = (text or "").split("\n")
        hashes = [0] * (span - 1) + [int(md5(r.encode()).hexdigest()[:8], 16) % 1_000_003 for r in rows]
        hits = []
        for i in range(len(rows)):
            value = 0
            for h in hashes[i:i + span]:
                value = (value * 131_071 + h) % 1_000_003
            hits.append(value % divisor == 0)
        cuts = [0]
        for i, hit in enumerate(hits[:-1], 1):
            settled = hit and not any(hits[max(0, i - least):i - 1])
            if settled and (least == 1 or least <= i <= len(rows) - least):
                cuts.append(i)
        spans = []
        for start, end in zip(cuts, [*cuts[1:], len(rows)], strict=True):
            while most and end - start >= 2 * most:
                spans.append((start, start + most))
                start += most
            spans.append((start, end))
        left = []
        for start, end in spans:
            chunk = "\n".join(rows[start:end])
            if end - start > 1 and re.search(r"[^\x20\x09-\x0d]", chunk):
                if chunk in seen:
                    continue
                seen.add(chunk)
            left += rows[start:end]
        found.append("\n".join(left))
    return found


@pytest.mark.parametrize("least,most,divisor", [(1, None, 4), (2, None, 2), (3, 4, 2), (1, 5, 4), (2, 8, 2)])
def test_spaced_and_cut_chunks(spark, least, most, divisor):
    shared = [lines(n, 40 + n) for n in (2, 3, 5, 9, 30)]
    texts = awkward() + ["\n".join(lines(i % 4, 60 + i) + shared[i % 5] + lines(i % 3, 80 + i)) for i in range(40)]
    texts += ["\n".join(["again"] * n + ["end"]) for n in (1, 2, 5, 17, 18, 200)] + ["\n" * 30, "\n".join(shared[3])]
    found = line_dedup(documents(spark, texts).repartition(3), divisor=divisor, least=least, most=most).collect()
    assert [r.text for r in sorted(found)] == plain(texts, 3, divisor, least, most)


def test_copies_lose_all_lines_and_runs_all_but_one_part(spark):
    texts = ["\n".join(lines(n, 70 + n)) for n in range(2, 30)]
    run = "\n".join(["same line"] * 100)
    found = {r.doc_id: r for r in line_dedup(documents(spark, texts + texts + [run]), divisor=2, least=2, most=4).collect()}
    assert all(found[i].text == t for i, t in enumerate(texts, 1))
    assert all(found[len(texts) + i].text == "" for i in range(1, len(texts) + 1))
    assert len(found[2 * len(texts) + 1].text.split("\n")) <= 4 + 7


def test_a_text_of_very_many_lines(spark):
    text = "\n".join(f"line {i * 7919 % 1_000_003}" for i in range(300_000))
    found = {r.doc_id: r for r in line_dedup(documents(spark, [text, text]), least=2).collect()}
    assert (found[1].n_removed, found[2].n_removed, found[2].text) == (0, 300_000, "")
