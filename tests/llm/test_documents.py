"""The operators on documents, against plain rewritings and on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import roots, shingles
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, elias_fano, fingerprints, language, neardup, packing, quality, queries, token_store, tokens,
)

pytest_plugins = ()


@pytest.fixture(scope="module")
def encoded(documents):
    tokenizer = tokens.Encoder(tokens.public_vocabulary()).tokenizer
    keys = sorted(documents)
    found = tokenizer.encode_batch([documents[key] for key in keys], add_special_tokens=False)
    return {key: item.ids for key, item in zip(keys, found, strict=True)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 9), (5, 3), (1000, 10), (1000, 1 << 40), (3000, 2**63)):
        values = np.sort(rng.integers(0, top + 1, n, np.uint64, endpoint=False))
        code = elias_fano.EliasFano(elias_fano.encode(values))
        assert (code.values() == values).all()
        assert [code.select(i) for i in range(0, n, 7)] == values[::7].tolist()
    assert len(elias_fano.EliasFano(elias_fano.encode([])).values()) == 0
    sparse = np.arange(0, 10**7, 1000)
    assert len(elias_fano.encode(sparse)) < 2 * len(sparse)
    with pytest.raises(ValueError):
        elias_fano.encode([2, 1])


@pytest.mark.parametrize("part", [1 << 20, 40])
def test_encoder_equals_the_tokenizer(monkeypatch, documents, part):
    monkeypatch.setattr(tokens, "PART_CHARS", part)
    odd = ["", "a", " a b  c d", "x \n y z", "a b\nc d e", "l'été s'il  ", "\xa0a b c\xa0 d", "don't <|endoftext|> we'll",
           " lead a", "trail ", " ", "\n", "﷐a b a", "a b c", "1 2 3!! ???"]
    texts = odd + list(documents.values())
    coder = tokens.Encoder(tokens.public_vocabulary())
    want = [item.ids for item in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    ids, ends = coder.encode_many(texts)
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == want


@pytest.mark.parametrize("part", [1 << 20, 8, 3])
def test_special_strings_are_the_librarys_tokens(spark, monkeypatch, part):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "PART_CHARS", part)
    library = Tokenizer.from_file(tokens.public_vocabulary())
    texts = [
        "a <|endoftext|> b", "<|endoftext|>", "one two<|endoftext|>three four  five six", "x <|endoftext|><|endoftext|> y z",
        "a b c d e f g h <|endoftext|> i j k l m n o p", "<|endoftext| > none <|end of", "plain words only here",
    ]
    ids, ends = tokens.Encoder(tokens.public_vocabulary()).encode_many(texts * 2)
    want = [library.encode(text, add_special_tokens=False).ids for text in texts * 2]
    assert want[0] == [64, 220, 50256, 275] and [own.tolist() for own in np.split(ids, ends[:-1])] == want
    library.encode_special_tokens = True
    ids, ends = tokens.Encoder(tokens.public_vocabulary(), plain_specials=True).encode_many(texts)
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert want[0] == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]
    assert [own.tolist() for own in np.split(ids, ends[:-1])] == want


def test_special_strings_in_the_queries_operators(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "c")], "doc_id long, text string")
    for plain, n in ((False, 5), (True, 10)):
        store = token_store.encode_documents(spark, df, tokens.public_vocabulary(), plain_specials=plain).collect()
        assert {r.doc_id: (r.start, r.n_tokens) for r in store} == {1: (0, n), 2: (n, 2)}
        rows = packing.pack(df, tokens.public_vocabulary(), plain_specials=plain).collect()
        assert {r.doc_id: r.doc_tokens for r in rows} == {1: n, 2: 2}


def test_token_store(spark, tables, encoded):
    got = {row.doc_id: row for row in queries.op1_token_store(spark, tables).collect()}
    start = 0
    for key in sorted(encoded):
        ids = encoded[key] + [0]
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(encoded)


def test_token_shard_selects_documents():
    ids = np.arange(10, dtype=np.uint16)
    data = b"".join(token_store.shard_bytes([None, -5, -5, 0, 2**62], np.array([2, 3, 3, 9, 10]), ids))
    shard = token_store.Shard(data)
    assert shard.doc_ids() == [None, -5, -5, 0, 2**62]
    assert [shard.document(i).tolist() for i in range(5)] == [[0, 1], [2], [], [3, 4, 5, 6, 7, 8], [9]]


def test_reading_a_shard_selects(monkeypatch):
    """Neither the stops nor the document ids are unpacked into a table."""
    def unpacked(self):
        raise AssertionError("all values unpacked")

    rng = np.random.default_rng(4)
    doc_ids = [None] * 3 + np.sort(rng.integers(-(2**62), 2**62, 2000)).tolist()
    ends = np.cumsum(rng.integers(0, 40, len(doc_ids)) * (rng.random(len(doc_ids)) < 0.5))
    ids = rng.integers(0, 50_000, ends[-1]).astype(np.uint16)
    data = b"".join(token_store.shard_bytes(doc_ids, ends, ids))
    monkeypatch.setattr(elias_fano.EliasFano, "values", unpacked)
    shard = token_store.Shard(data)
    got = list(shard.documents())
    assert [key for key, _, _ in got] == doc_ids and [begin for _, begin, _ in got] == [0, *ends[:-1].tolist()]
    assert (np.concatenate([own for _, _, own in got]) == ids).all()
    assert all((shard.document(i) == got[i][2]).all() for i in range(0, len(got), 97))


def test_packing(spark, tables, encoded):
    rows = queries.op8_packing(spark, tables).toPandas()
    for key, own in rows.sort_values("start").groupby("doc_id"):
        ids, at = encoded[key] + [1], 0
        for piece in own.itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids)
            assert piece.ids_crc32 == crc(ids[at : at + piece.length])
            at += piece.length
        assert at == len(ids)
    assert set(rows.doc_id) == set(encoded)
    rows = rows.sort_values(["sequence_id", "offset"])
    whole = rows.groupby("sequence_id").length
    assert (rows.offset == whole.cumsum() - rows.length).all() and whole.sum().max() <= packing.SEQUENCE
    assert len(whole) <= 1.02 * rows.length.sum() / packing.SEQUENCE + 1


def test_first_fit_decreasing_equals_the_plain_search():
    lengths = np.random.default_rng(3).integers(1, 100, 400)
    room, want = [], {}
    for item in sorted(range(400), key=lambda i: (-lengths[i], i)):
        place = next((b for b, free in enumerate(room) if free >= lengths[item]), len(room))
        room += [100] * (place == len(room))
        want[item] = (place, 100 - room[place])
        room[place] -= lengths[item]
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    assert [want[i] for i in range(400)] == list(zip(bins.tolist(), offsets.tolist(), strict=True))


def test_fingerprints(spark, tables, documents):
    got = {row.doc_id: row for row in queries.op3_fingerprints(spark, tables).collect()}
    order, errors = sorted(documents, reverse=True), []
    for i, key in enumerate(order):
        text, following = documents[key], documents[order[(i + 1) % len(order)]]
        changed = fingerprints.edited(text, following)
        row = got[key]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for other, near in ((changed, row.near_edited), (following, row.near_next)):
            a, b = shingles(text), shingles(other)
            errors.append(abs(near - (len(a & b) / len(a | b) if a | b else 1)))
    assert len(got) == len(order) and max(errors) < 0.15 and np.mean(errors) < 0.03
    same = {}
    for key, text in documents.items():
        assert same.setdefault(text, got[key].fingerprint) == got[key].fingerprint


def test_near_duplicates(spark, tables, documents):
    got = {row.doc_id: row for row in queries.op4_neardup(spark, tables).collect()}
    sets = {key: shingles(text) for key, text in documents.items()}
    want = roots(sets, 85)
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {
        key: (len(sets[key]), want[key], want[key] == key) for key in documents
    }


def test_a_large_group_of_near_copies(spark):
    """Copies around a center, a chain of slow changes, and texts that only share half."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(120):
        own = list(base)
        for place in rng.choice(120, 2, replace=False):
            own[place] = f"r{rng.integers(1 << 30)}"
        texts.append(" ".join(own))
    chain = [f"c{i}" for i in range(150)]
    for step in range(25):
        chain[step * 5] = f"n{step}"
        texts.append(" ".join(chain))
    texts += [" ".join([f"h{i}" for i in range(60)] + [f"u{k}x{i}" for i in range(60)]) for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent in (80, 85):
        got = {row.doc_id: row.component_id for row in neardup.near_duplicates(df, percent).collect()}
        assert got == roots({i: shingles(text) for i, text in enumerate(texts)}, percent)


def test_blocks_and_slices_find_what_pairs_find(spark, monkeypatch):
    """Small blocks: every bucket is cut into several."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "SLICE", 4)
    test_a_large_group_of_near_copies(spark)


def test_decontamination_places(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = [
        (1, "Vor: ALPHA, beta-gamma delta epsilon zeta eta theta iota KAPPA! nach"), (2, "alpha beta gamma"),
        (3, f"é {item} é {item}"), (4, None), (5, "short one here"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(
        [(10, item), (2, "Short ONE"), (2, "Short ONE"), (3, None), (4, "..."), (None, "one here")], "item_id long, text string"
    )
    got = {row.doc_id: row for row in decontaminate.contamination(df, bench).collect()}
    assert (got[1].n_hit, got[1].items, got[2].n_hit, got[4].n_words) == (10, [10], 0, 0)
    begin, stop = got[1].spans[0]
    assert docs[0][1][begin:stop] == "ALPHA, beta-gamma delta epsilon zeta eta theta iota KAPPA"
    assert got[3].n_hit == 22 and [docs[2][1][a:b] for a, b in got[3].spans] == [item, item]
    assert (got[5].n_hit, got[5].n_items) == (3, 1)
    kept = decontaminate.drop_contaminated(df, bench)
    assert sorted(row.doc_id for row in kept.collect()) == [2, 4]


def test_blocks_of_patterns_agree(spark, tables, monkeypatch):
    want = {row.doc_id: row for row in queries.op10_decontamination(spark, tables).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert {row.doc_id: row for row in queries.op10_decontamination(spark, tables).collect()} == want


def test_language_on_held_out_documents(spark, tables):
    got = queries.op7_language(spark, tables).join(spark.read.parquet(f"{tables}/documents.parquet"), "doc_id")
    rows = got.where("held_out and lang is not null").collect()
    assert len(rows) > 20 and np.mean([row.lang == row.lang_pred for row in rows]) >= 0.95
    assert got.where(f"held_out <> (crc32(string(doc_id)) % 3 = 1) or score < 0 or score > 1").isEmpty()


def test_more_languages_than_bits_of_a_word(spark):
    rng = np.random.default_rng(7)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    vocabularies = [["".join(rng.choice(letters, 6)) for _ in range(40)] for _ in range(70)]
    rows = [
        (70 * i + lang, " ".join(rng.choice(vocabularies[lang], 60)), f"l{lang:02d}")
        for i in range(9) for lang in range(70)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {row.doc_id: row for row in language.identify(df).collect()}
    assert all(got[key].lang_pred == lang for key, _, lang in rows if got[key].held_out)
    assert {got[key].lang_pred for key, _, _ in rows} == {f"l{lang:02d}" for lang in range(70)}
    assert language.drop_unidentified(df).count() == len(rows)


def test_quality_against_labels(spark, tables):
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    rows = queries.op6_quality(spark, tables).join(labels, "doc_id").collect()
    good = [row.kept for row in rows if row.quality == 1]
    poor = [row.kept for row in rows if row.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(poor) <= 0.2


def test_texts_without_a_letter_have_no_grams():
    _, counts = language.grams(["²", "½ ³", "12 !", "", "a²", "é"])
    assert (counts > 0).tolist() == [False, False, False, False, True, True]


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    rates = np.array([[0.5, 0.97], [0.4, 0.98], [0.45, 0.95], [0.5, 0.96]])
    cast = np.where(rng.random((20_000, 4)) < np.where(good[:, None], rates[:, 1], rates[:, 0]), good[:, None], ~good[:, None])
    patterns, counts = np.unique(cast.astype(int), axis=0, return_counts=True)
    prior, right = quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.05 and np.abs(right - rates.T).max() < 0.1


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "without an id stands here")], "item_id long, text string")
    vocabulary = tokens.public_vocabulary()
    n = odd.count()
    store = token_store.encode_documents(spark, odd, vocabulary).collect()
    assert len(store) == n and sorted(r.n_tokens for r in store)[:3] == [1, 1, 1]
    assert sorted(r.start for r in store) == sorted(
        np.cumsum([0] + [r.n_tokens for r in sorted(store, key=lambda r: r.start)][:-1]).tolist()
    )
    prints = fingerprints.with_next(odd).collect()
    assert len(prints) == n and len({r.fingerprint for r in prints if r.doc_id in (5, 6)}) == 1
    assert {r.fingerprint for r in prints if r.doc_id in (1, 2, 3)} == {""}
    near = neardup.near_duplicates(odd).collect()
    assert len(near) == n
    assert {(r.doc_id, r.component_id, r.n_shingles) for r in near if r.doc_id in (1, 2, 3, 4, 5, 6, 7, 8)} == {
        (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 5, 4), (6, 5, 4), (7, 7, 59996), (8, 7, 59997)
    }
    assert {r.lang_pred for r in language.identify(odd).collect() if r.doc_id in (1, 2, 3, 10)} == {"und"}
    assert len(quality.rate(odd).collect()) == n
    found = {r.doc_id: r for r in decontaminate.contamination(odd, bench).collect()}
    assert found[9].n_words == 1 and found[1].n_words == 0
    pieces = packing.pack(odd, vocabulary).collect()
    assert sum(r.length for r in pieces) == sum(r.n_tokens for r in store)


def test_filters_keep_all_columns(spark, odd):
    bench = spark.createDataFrame([(1, "without an id stands here")], "item_id long, text string")
    for kept in (
        quality.drop_poor(odd), language.drop_unidentified(odd, 0.0), neardup.drop_near_duplicates(odd),
        decontaminate.drop_contaminated(odd, bench),
    ):
        assert kept.schema.names == odd.schema.names and kept.where(F.col("`__x`") != "__x").isEmpty()
    kept = [r.doc_id for r in neardup.drop_near_duplicates(odd).collect()]
    assert sorted(k for k in kept if k is not None) == [-3, 1, 2, 3, 4, 5, 7, 9, 10] and kept.count(None) == 2
    assert None in {r.text for r in decontaminate.drop_contaminated(odd, bench).collect()}
    assert not any("stands here" in (r.text or "") for r in decontaminate.drop_contaminated(odd, bench).collect())


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    vocabulary = tokens.public_vocabulary()
    for got in (
        token_store.encode_documents(spark, none, vocabulary), fingerprints.with_next(none), fingerprints.fingerprint(none),
        neardup.near_duplicates(none), neardup.drop_near_duplicates(none), language.identify(none),
        language.drop_unidentified(none), quality.rate(none), quality.drop_poor(none),
        decontaminate.contamination(none, bench), packing.pack(none, vocabulary),
    ):
        assert got.isEmpty()
    assert decontaminate.drop_contaminated(odd, bench).count() == odd.count()


def test_ranges_are_even_however_many(spark):
    """Bounds of very many ranges, of which repeated ids and missing ids fill some."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, 5).otherwise(F.col("id") * 7919 % 1_000_003).alias("doc_id"),
        F.lit("a text").alias("text"),
    )
    placed = fingerprints._ordered(rows).select(*fingerprints._KEY)
    heads = (
        placed.repartitionByRange(1000, *fingerprints._KEY)
        .groupBy(F.spark_partition_id()).agg(F.min(F.struct(*fingerprints._KEY)).alias("head"), F.count("*").alias("n"))
        .collect()
    )
    bounds = sorted(tuple(row["head"]) for row in heads)
    assert len(bounds) > 900 and max(row["n"] for row in heads) < 800
    number = fingerprints._range_of(bounds)
    sample = placed.where("pmod(xxhash64(_mark), 50) = 3").toPandas()
    counts = np.bincount(number(*(sample[name] for name in fingerprints._KEY)), minlength=len(bounds))
    assert counts.max() < 30 and counts.sum() == len(sample)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_document_over_any_number_of_ranges(spark, ranges):
    rows = [(i % 60 if i % 7 else None, f"text {i % 11} of these with some words more {i % 5}") for i in range(300)]
    rows += [(9, "the same again in very many rows")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = fingerprints.with_next(df, ranges=ranges).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1][:32], hashlib.md5(r[1].encode()).hexdigest()))
    want = [
        (key, hashlib.sha256(fingerprints.edited(text, order[(i + 1) % len(order)][1]).encode()).hexdigest())
        for i, (key, text) in enumerate(order)
    ]
    assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)


def test_benchmark_in_many_blocks_without_the_driver(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    items = [(i, " ".join(f"q{i}w{j}" for j in range(14))) for i in range(60)] + [(None, "no name but ten words in this one item here"), (7, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, f"before {items[i][1]} after") for i in range(0, 60, 7)]
    docs += [(100, "said two words here"), (101, "clean"), (102, None), (103, "no name but ten words in this one item here")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(decontaminate._blocks(bench, 10)) > 10
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.contamination(df, bench).collect()}
    assert got == {i: (14, [i]) for i in range(0, 60, 7)} | {100: (2, [7]), 101: (0, []), 102: (0, []), 103: (10, [])}
    kept = decontaminate.drop_contaminated(df, bench).collect()
    assert sorted(r.doc_id for r in kept) == [101, 102]


def test_languages_equal_plain_sets(spark, tables, documents):
    """lang_pred against sets of n-grams without any filter, ties included."""
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", "lang").collect()

    def plain(text):
        line = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
        data = f" {line} ".encode() if line else b""
        return [data[i : i + language.GRAM] for i in range(len(data) - language.GRAM + 1)]

    shown = {}
    for row in rows:
        if row.lang is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 != 1:
            shown.setdefault(row.lang, []).append(set(plain(row.text)))
    sets = {}
    for lang, own in shown.items():
        own = [grams for grams in own if grams]
        counts = {}
        for grams in own:
            for gram in grams:
                counts[gram] = counts.get(gram, 0) + 1
        sets[lang] = {gram for gram, n in counts.items() if n >= len(own) * language.SHARE}
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(spark.read.parquet(f"{tables}/documents.parquet")).collect()}
    for row in rows:
        own = plain(row.text)
        shares = {lang: sum(gram in sets[lang] for gram in own) / len(own) for lang in sorted(sets)} if own else {}
        want = max(shares, key=shares.get) if shares else "und"
        assert found[row.doc_id][0] == want and abs(found[row.doc_id][1] - shares.get(want, 0)) < 0.01


def test_the_table_grows_with_the_n_grams(spark, monkeypatch):
    import random

    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(400)]
    rows = [(i, " ".join(words[:200]) if i % 2 else " ".join(words[200:]), "ab"[i % 2]) for i in range(20)]
    monkeypatch.setattr(language, "CELLS", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, table = language.learn(df)
    model = language.Model(languages, table)
    assert table.shape[1] >= 16 * 2000 and model.chance.max() < 0.01
    names, _ = model.predict([row[1] for row in rows])
    assert names == [row[2] for row in rows]


def test_quality_copies_do_not_fill_the_sample(spark):
    good = [(i, " ".join(f"word{j % 17}x these are plain words of some length {i}" for j in range(9))) for i in range(60)]
    bad = [(100 + i, "### *** %%% &&& " * 30 + str(i)) for i in range(20)]
    many = spark.createDataFrame(good + bad + [good[0]] * 3000, "doc_id long, text string").repartition(3)
    a, b = quality.learn(many, 200), quality.learn(many.repartition(5), 200)
    assert (a.weights == b.weights).all()
    # However many copies, the bad ones are still told from them.
    rated = {r.doc_id: r.score for r in quality.rate(many, quality.learn(many, 4000)).collect()}
    assert max(rated[i] for i, _ in bad) < min(rated[i] for i, _ in good)


def test_long_shapes_are_told_apart():
    a, b = "Aa0." * 6 + "A", "Aa0." * 6 + "0"
    first, second = (quality.features(*quality.measures(f"{x} {x} {x}")) for x in (a, b))
    assert first.keys() != second.keys()
