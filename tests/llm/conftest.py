import os
import re

import pytest
from pyspark.sql import functions as F

TABLES = os.environ.get("TIDEMARK_TEST_TABLES", "/root/testdata/sf0.001")

#: Columns that an operator might use itself.
CLASHING = ("class", "row", "part", "low", "score", "kept", "root", "slot", "lot", "digest", "guest", "__x")


def pytest_collection_modifyitems(items):
    skip = pytest.mark.skip(reason="no test tables")
    for item in items:
        if "tables" in getattr(item, "fixturenames", ()) and not os.path.isdir(TABLES):
            item.add_marker(skip)


@pytest.fixture(scope="session")
def tables():
    return TABLES


@pytest.fixture(scope="session")
def documents(spark, tables):
    """Rows of the documents table: doc_id to text."""
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def words(text):
    """Words of the near-duplicate operators."""
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size=5):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def roots(sets, percent):
    """Least key of each key's component under the linking rule, by all pairs."""
    parent = {key: key for key in sets}

    def find(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {key: find(key) for key in keys}


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties and repeated rows, and clashing columns."""
    long = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "one two", "en", "a"),
        (5, "the same text in several rows of it", "en", "a"), (5, "the same text in several rows of it", "en", "a"),
        (6, "the same text in several rows of it", None, "b"), (7, long, "en", None), (8, long + " tail", "en", "b"),
        (None, "a text without an id stands here", "en", None), (None, None, None, None),
        (-3, "négatif d'abord été \U0001f600 fin", "fr", "c"), (9, "x" * 300_000, "xx", "d"), (10, "12345 !!!", "en", "d"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns(
        {name: F.lit(name) for name in CLASHING}
    )
