"""Hard negatives, Merkle manifest and SimHash against plain rewritings, and on odd rows."""

import math
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from conftest import CLASHING
from pyspark.sql import functions as F

from tidemark.llm import bk_tree, common, gnat, hard_negatives, merkle, simhash
from tidemark.llm.graph import components

pytest_plugins = ()


# Hard negatives


def mined(rows):
    own = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in vector])
        for i, vector, label in rows
        if i is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    anchors, out = {}, []
    for i, label, vector in own:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, vector)), (label, vector))
    for i, (label, vector) in anchors.items():
        scored = [(-score(vector, v), j, kind == label) for j, kind, v in own if j != i]
        for p, j in sorted(x[:2] for x in scored if x[2])[:5]:
            fit = sorted(x[:2] for x in scored if not x[2] and -30 * p <= -100 * x[0] <= -90 * p)
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(fit[:10], 1)]
    return sorted(out)


def negatives(df):
    found = hard_negatives.mine(hard_negatives.integers(hard_negatives.shifted(df)), F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, found.collect()))


VECTORS = "vec_id long, embedding array<float>, label int"


def test_hard_negatives_of_the_table(spark, tables):
    df = spark.read.parquet(f"{tables}/embeddings.parquet")
    want = mined([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert negatives(df) == want and want


@pytest.mark.parametrize("part", [32_768, 50])
def test_hard_negatives_with_copies_in_many_parts_and_blocks(spark, monkeypatch, part):
    monkeypatch.setattr(hard_negatives, "PART", part)
    monkeypatch.setattr(hard_negatives, "BLOCK", 2 if part == 50 else 8192)
    monkeypatch.setattr(hard_negatives, "HELD_BYTES", 1 << 20 if part > 50 else 8 * 8 * 1024)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 200)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    vectors = centers[rng.integers(0, 12, 1500)] + 0.1 * rng.normal(size=(1500, 8))
    vectors[rng.random(1500) < 0.35] = vectors[0]
    rows = [(int(i), [float(x) for x in v], int(rng.integers(0, 4))) for i, v in enumerate(vectors.astype(np.float32))]
    assert negatives(spark.createDataFrame(rows, VECTORS)) == mined(rows)


def test_hard_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [2.0, 1.0], 0), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1),
        (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (3, [0.4], 3), (4, [], 1), (5, None, 1), (6, [nan, 1.0], 1),
        (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 1.0], None), (None, [1.0, 0.0], 1), (7, [1.0, 0.1], 0),
        (100, [-1.0, 0.0], 2), (-100, [0.3, 0.9], 2), (11, [0.6, 0.5], 0), (12, [0.6, 0.5, 9.0], 1),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    df = df.withColumns({name: F.lit(name) for name in (*CLASHING, "code", "mark", "key", "rank")})
    assert negatives(df) == mined(rows) and mined(rows)
    assert negatives(df.limit(0)) == []
    assert negatives(df.where("vec_id is null")) == [] and negatives(df.where("vec_id = 1")) == []
    with pytest.raises(ValueError):
        negatives(spark.createDataFrame([(1, [4e5, 0.0], 1)], VECTORS))


def test_ranges_eliminate_siblings_and_lose_nothing():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 16)) * 300
    rows = np.floor(centers[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16)) * 20)
    top = int((rows**2).sum(axis=1).max())
    tree = gnat.Tree(gnat.Vectors(rows[:1000], top), 32)
    own = gnat.Vectors(rows, top)
    leaf = tree.place(own, learn=True)
    queries = own.take(np.arange(50))
    scores = queries.rows @ rows.T
    high = np.sort(scores, axis=1)[:, -20].copy()
    low = np.sort(scores, axis=1)[:, -40].copy()
    seen = np.zeros((50, tree.leaves), bool)
    for number, asked in tree.search(queries, low, high):
        seen[asked, number] = True
    for i in range(50):
        wanted = (scores[i] >= low[i]) & (scores[i] <= high[i])
        assert wanted.any() and seen[i, leaf[wanted]].all()
    # Clusters are told apart: most of the 6000 rows are never compared.
    assert (seen * np.bincount(leaf, minlength=tree.leaves)).sum() < 0.3 * 50 * 6000


# Merkle manifest


def digest(text):
    return sha256(text.encode()).hexdigest()


def tree(leaves, fanout):
    """Root and, for each leaf, the digests left and right of it, level by level."""
    steps, places, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(places):
            begin = place // fanout * fanout
            run = level[begin : begin + fanout]
            steps[i].append(("".join(run[: place - begin]), "".join(run[place - begin + 1 :])))
            places[i] = place // fanout
        level = [digest("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], steps


def verified(rows, fanout=16):
    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def forged(row):
        if row[0] is None or zlib.crc32(str(row[0]).encode()) % 5:
            return leaf(row)
        text = row[4] and re.sub("[A-Z]", lambda m: m[0].lower(), row[4])
        return leaf((*row[:4], text))

    sources = sorted({row[1] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [
        sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources
    ]
    lower = [tree([leaf(r) for r in group], fanout) for group in groups]
    root, upper = tree([x[0] for x in lower], fanout)
    out = []
    for group, (subroot, steps), above in zip(groups, lower, upper, strict=True):
        for row, own in zip(group, steps, strict=True):
            now = forged(row)
            for left, right in own + above:
                now = digest(left + now + right)
            siblings = digest("".join(left + right for left, right in own + above))
            out.append((row[0], leaf(row), subroot, root, siblings, now, now == root))
    return sorted(out, key=str)


def manifest_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def checked(df, **options):
    return sorted(map(tuple, merkle.verify_documents(df, **options).collect()), key=str)


def test_manifest_of_the_table(spark, tables):
    df = spark.read.parquet(f"{tables}/documents.parquet")
    got = checked(df)
    assert got == verified(manifest_rows(df)) and not all(row[-1] for row in got)


@pytest.mark.parametrize("fanout", [2, 3])
def test_butterfly_rounds_over_many_blocks_and_trees(spark, fanout):
    """Blocks of 8 or 27 leaves: trees whose last subtrees are short at several levels, and many trees."""
    sizes = {None: 1, "a": 8, "b": 9, "c": 65, "d": 700, "é": 27, "Z": 28, "": 2} | {f"s{i}": 1 for i in range(70)}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7919 % 10_007, source, "en", n, f"Text {n}"))
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert checked(df, fanout=fanout) == verified(rows, fanout)


def test_manifest_odd_rows(spark, odd):
    got = checked(odd.withColumns({name: F.lit(1) for name in ("tree", "rank", "leaf", "block", "_mark", "_seq")}))
    assert got == verified(manifest_rows(odd)) and len(got) == odd.count()
    assert checked(odd.limit(0)) == []
    one = odd.where("doc_id = 4")
    assert checked(one) == verified(manifest_rows(one))


def test_a_hot_tree_meets_its_upper_path_in_slices(spark, monkeypatch, odd):
    monkeypatch.setattr(merkle, "SLICE", 2)
    rows = [(i, "hot" if i % 3 else "cold", None, i, f"T{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert checked(df, fanout=2) == verified(rows, 2)


# SimHash


def simhash_of(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def grouped(prints, radius=4):
    """The number of each print's component, by all pairs."""
    values, parent = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def similar(rows):
    prints = [simhash_of(text) for _, text in rows]
    root, least = grouped(prints), {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return sorted(((key, f"{p:016x}", least.get(r)) for (key, _), p, r in zip(rows, prints, root, strict=True)), key=str)


def test_simhash_of_the_table(spark, tables, documents):
    found = simhash.near_duplicates(spark.read.parquet(f"{tables}/documents.parquet")).collect()
    want = similar(sorted(documents.items()))
    assert sorted(map(tuple, found), key=str) == want and len({row[2] for row in want}) < len(want)


def test_simhash_odd_rows(spark, odd):
    found = simhash.near_duplicates(odd.withColumns({n: F.lit(1) for n in ("print", "shard", "least")})).collect()
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, found), key=str) == similar(rows)
    assert simhash.near_duplicates(odd.limit(0)).collect() == []
    nameless = simhash.near_duplicates(odd.where("doc_id is null and text is not null")).collect()
    assert [row.component_id for row in nameless] == [None]


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"Word{i % 977}  x{i}" for i in range(80_000))
    whole = simhash.fingerprint([simhash._shingle_hashes(text, 4, 42)])
    assert int(whole[0]) == simhash_of(text)
    monkeypatch.setattr(simhash, "BLOCK", 100)
    short = "one two three " * 200 + "x" * 500 + " tail"
    assert int(simhash.fingerprint([simhash._shingle_hashes(short, 4, 42)])[0]) == simhash_of(short)


@pytest.mark.parametrize("shard", [8192, 100])
def test_shards_in_slices_lose_no_link(spark, monkeypatch, shard):
    """A large group of fingerprints around one, in one shard that is cut in many slices."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = np.random.default_rng(1)
    values = []
    for center in [int(x) for x in rng.integers(0, 1 << 63, 60)] + [7] * 60:
        for _ in range(15):
            value = center
            for bit in rng.integers(0, 64, int(rng.integers(0, 8))):
                value ^= 1 << int(bit)
            values.append(value)
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.link(spark.createDataFrame([(x,) for x in signed], "print long"))
    assert links.count() < 15 * 2 * len(values) if shard == 8192 else True
    names = {r.node: r.root for r in components(links).collect()}
    got = {}
    for x, r in zip(signed, grouped(values), strict=True):
        got.setdefault(r, set()).add(names.get(x, x))
    assert all(len(names) == 1 for names in got.values())
    assert len({next(iter(names)) for names in got.values()}) == len(got)


def test_bk_tree_follows_its_edges():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 3000, np.uint64)
    values[1000:1200] = values[:200] ^ np.uint64(5)
    groups = np.repeat([3, 9, 4], 1000)
    forest = bk_tree.Forest(values, groups)
    for node in range(3000):
        for edge, child in enumerate(forest.children[node]):
            if child >= 0:
                assert int(values[node] ^ values[child]).bit_count() == edge and groups[node] == groups[child]
    found = {(int(a), int(b)) for x in forest.near(values, groups, 4) for a, b in zip(*x, strict=True)}
    close = np.bitwise_count(values[:, None] ^ values) <= 4
    assert found == {(int(a), int(b)) for a, b in np.argwhere(close & (groups[:, None] == groups))}


def test_join_split_keeps_every_row(spark):
    left = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(3000)], "n long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 3000, 2)] + [(1, "one")], "k long, v string")
    got = {tuple(r) for r in common.join_split(left, right, "k").select("n", "k", "v").collect()}
    assert got == {(n, k, "one" if k == 1 else f"v{k}" if k % 2 == 0 else None) for n, k in ((i, 1 if i % 3 else i) for i in range(3000))}
