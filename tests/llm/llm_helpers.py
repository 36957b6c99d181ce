"""Small tables with what operators have to stand, and plain versions to compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, source string, n_chars long, kept string, _row int, h string, row string, size int"


def words(text):
    return WORD.findall(text or "")


def documents(spark, texts, sources=None, first=1):
    """Documents with columns whose names operators use inside."""
    rows = []
    for i, text in enumerate(texts):
        source = sources[i] if sources else f"s{i % 3}"
        rows.append((first + i, text, source, len(text or ""), "x", 7, "y", "z", i))
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed):
    import random

    random = random.Random(seed)
    parts = "an be co du el fo ga hi".split()
    return " ".join("".join(random.choices(parts, k=random.randint(1, 4))) for _ in range(n))


def awkward():
    """Nulls, empty and blank texts, repeated ones, a very long one."""
    return [None, "", "   ", "\t\n", "one", "one two", "one  two", "one\ttwo ", prose(50, 1), prose(50, 1),
            prose(30_000, 2), "x" * 200_000, "é" * 70, " nbsp ", "a\x00b", prose(25, 3), prose(19, 4), prose(20, 5)]
