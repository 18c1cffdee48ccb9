"""Each stage on the rows before it, against plain rewritings."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from conftest import roots, shingles

import __spark_entry__ as entry_point
from checks.compare import compare
from tidemark.llm import packing, quality, queries, tokens
from tidemark.session import materialize


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = materialize(stage(spark, docs, tables), f"test-{name}")
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        assert docs.columns == names
        after = {r.doc_id for r in docs.collect()}
        assert after <= set(before) and docs.count() == len(after)
        if name == "quality":
            assert sum(labels.get(k) == 1 for k in set(before) - after) <= 2
        if name == "language":
            assert len(after) >= 0.99 * len(before)
        if name == "near_duplicates":
            want = roots({k: shingles(t) for k, t in before.items() if shingles(t)}, 80)
            assert after == set(want.values()) | {k for k in before if k not in want}
        if name == "decontamination":
            for key in set(before) - after:
                assert any(" ".join(text.split()[:3]) in " ".join(before[key].split()) or text for text in bench)
    assert corpus_pipeline.run(spark, tables).count() == docs.count()


def rescored(model, text):
    """A document's score by the learned weights, one feature after the other."""
    if not text or text.isspace():
        return 0.0
    own = quality.features(*quality.measures(text))
    return 1 / (1 + np.exp(-model.weights[-1] - sum(model.weights[place] * share for place, share in own.items())))


def language_shares(docs):
    """Of each text the best share of its n-grams that are common in one language, by plain sets."""
    def grams(text):
        plain = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
        if not any(map(str.isalpha, plain)):
            return []
        data = f" {plain} ".encode()
        return [data[i : i + 4] for i in range(max(1, len(data) - 3))]

    own = {key: grams(text) for key, (text, _) in docs.items()}
    totals, held = Counter(), {}
    for key, (_, lang) in docs.items():
        if lang is not None and own[key]:
            totals[lang] += 1
            held.setdefault(lang, Counter()).update(set(own[key]))
    common = [{gram for gram, n in held[lang].items() if n >= 0.02 * totals[lang]} for lang in held]
    return {
        key: max(sum(gram in known for gram in found) / len(found) for known in common) if found else 0.0
        for key, found in own.items()
    }


def leaking(docs, bench):
    """Documents that hold ten words of an item in a row, or all words of a shorter item."""
    def plain(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = set()
    for item in map(plain, bench):
        size = min(10, len(item))
        windows |= {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if size else set()
    sizes = set(map(len, windows))
    return {
        key for key, own in ((key, plain(text)) for key, text in docs.items())
        if any(tuple(own[i : i + size]) in windows for size in sizes for i in range(len(own) - size + 1))
    }


def test_stages_equal_plain_rewritings(spark, tables):
    """Each stage decides, both ways, as a plain rewriting does on the same rows."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(tokens.public_vocabulary())
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        before = {r.doc_id: r.text for r in rows}
        model = quality.learn(docs) if name == "quality" else None
        docs = materialize(stage(spark, docs, tables), f"test-{name}")
        if name == "packing":
            break
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality":
            scores = {key: rescored(model, text) for key, text in before.items()}
            sure = {key for key, score in scores.items() if abs(score - quality.LEAST) > 1e-3}
            assert len(sure) >= 0.99 * len(before)
            assert after & sure == {key for key in sure if scores[key] >= quality.LEAST}
            poor = [key for key in before if labels.get(key) == 0]
            assert poor and sum(key in after for key in poor) <= 0.2 * len(poor)
        if name == "language":
            shares = language_shares({r.doc_id: (r.text, r.lang) for r in rows})
            # The filters' chance answers are only corrected for on average.
            sure = {key for key, share in shares.items() if abs(share - 0.2) > 0.05}
            assert len(sure) >= 0.95 * len(before)
            assert after & sure == {key for key in sure if shares[key] >= 0.2}
        if name == "decontamination":
            leaks = leaking(before, bench)
            assert leaks and after == set(before) - leaks
    pieces = docs.toPandas()
    assert set(pieces.doc_id) == set(before)
    for key, own in pieces.sort_values("start").groupby("doc_id"):
        ids, at = library.encode(before[key] or "", add_special_tokens=False).ids + [packing.END], 0
        for piece in own.itertuples():
            cut = np.array(ids[at : at + piece.length], "<u4")
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), zlib.crc32(cut.tobytes()))
            at += piece.length
        assert at == len(ids)
    pieces = pieces.sort_values(["sequence_id", "offset"])
    lengths = pieces.groupby("sequence_id").length
    assert (pieces.offset == lengths.cumsum() - pieces.length).all() and lengths.sum().max() <= packing.SEQUENCE


@pytest.mark.parametrize("name", list(queries.oracle()))
def test_query_equals_sql(spark, tables, name):
    assert compare(spark, tables, [name])[name].startswith("ok")


def test_all_are_registered():
    own = entry_point.queries()
    assert all(any(name.startswith(f"op{n}_") for name in own) for n in range(1, 11)) and "pipeline" in own
