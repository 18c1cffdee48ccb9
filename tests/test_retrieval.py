import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as texts
from tidemark.functions.embedding import Embedder, hashed_words, word_bucket
from tidemark.operators import retrieval
from tidemark.plans import assistant, end_to_end, medallion
from tidemark.profiles import COMMERCIAL, HEALTH_TECH, MANUFACTURING, ROBOTICS

T0 = datetime(2026, 1, 1)


@pytest.mark.parametrize(
    "profile, question, found",
    [
        (HEALTH_TECH, "what is our revenue trend this quarter", {}),
        (HEALTH_TECH, "show me EU patients", {"region": "EU"}),
        (HEALTH_TECH, "patients in eu, please", {"region": "EU"}),
        (HEALTH_TECH, "éEU and EUé and EU_1", {}),
        (HEALTH_TECH, "(EU)", {"region": "EU"}),
        (HEALTH_TECH, "APAC before NA", {"region": "NA"}),  # vocabulary order wins
        (HEALTH_TECH, "", {}),
        (MANUFACTURING, "voltage faults at Texas_Giga_01", {"facility_id": "Texas_Giga_01"}),
        (
            ROBOTICS,
            "episodes with GRASP_FAIL on Optimus-Gen2.",
            {"failure_type_tag": "GRASP_FAIL", "robot_model_id": "Optimus-Gen2"},
        ),
        (ROBOTICS, "NO_FAILURE", {}),
    ],
)
def test_extract_terms(spark, profile, question, found):
    df = spark.createDataFrame([(question,)], "question string")
    assert retrieval.extract_terms(df, profile).first().filters == found


def test_term_with_symbol_edge_needs_a_word_after_it(spark):
    df = spark.createDataFrame([("66+",), ("66+x",), ("a66+x",), ("66+ x",)], "t string")
    got = [r[0] for r in df.select(texts.first_term(F.col("t"), ["66+"])).collect()]
    assert got == [None, "66+", None, None]


def test_folding_rules_out_nothing_that_matches(spark):
    """Characters that match an ASCII letter without being one, and mixed cases."""
    cases = [
        ("GRA\u017fP_FAIL", "GRASP_FAIL"),
        ("V\u0130S\u0131ON_OCCLUSION", "VISION_OCCLUSION"),
        ("\u212Aey", "KEY"),
        ("stra\u00dfe GRASP_FAIL \u03a3", "grasp_fail"),
        ("\u03a3OS", "\u03c3os"),
    ]
    import sys
    import unicodedata

    like = {
        chr(c)
        for c in range(128, sys.maxunicode)
        if unicodedata.category(chr(c))[0] == "L"
        and (chr(c).upper().isascii() or chr(c).lower()[0].isascii())
        and len(chr(c).upper()) == 1
    }
    assert like == set(texts.ASCII_LIKE)
    for text, term in cases:
        df = spark.createDataFrame([(text,)], "t string")
        plain = df.select(F.col("t").rlike(texts.term_pattern(term))).first()[0]
        assert plain, text
        assert df.select(texts.first_term(F.col("t"), [term])).first()[0] == term


def test_quoted(spark):
    cases = ["plain", "it's", 'say "it\'s"', "a\\b\nc\td"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert [r[0] for r in df.select(texts.quoted(F.col("t"))).collect()] == [repr(c) for c in cases]


def _accounts(spark, n=60):
    rows = [
        (T0 + timedelta(minutes=i), f"CUST-{i % 7}", ("FREE", "PRO", None)[i % 3], ("NA", "EU")[i % 2],
         i + 0.25, i, i % 5 == 0)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, COMMERCIAL.schema)


def test_chunks(spark):
    chunks = retrieval.build_chunks(_accounts(spark, 3), COMMERCIAL).orderBy("text").collect()
    by_id = {c.id for c in chunks}
    assert len(by_id) == 3 and all(i.startswith("COMMERCIAL-") for i in by_id)
    assert chunks[0].text == (
        "[COMMERCIAL] customer_id_hashed=CUST-0, plan_tier=FREE, region=NA, "
        "monthly_revenue=0.25, tenure_months=0, churned_flag=True"
    )
    assert chunks[2].metadata == {"region": "NA", "profile": "COMMERCIAL"}
    assert "plan_tier=None" in chunks[2].text
    robots = spark.createDataFrame([(T0, "r", "Apollo-1", [0.5, None], None, None, None)], ROBOTICS.schema)
    assert retrieval.build_chunks(robots, ROBOTICS).first().text == (
        "[ROBOTICS] robot_id=r, robot_model_id=Apollo-1, joint_positions=[0.5, None], "
        "camera_frame_uri=None, failure_type_tag=None, success_flag=None"
    )


def test_filter_by_terms(spark):
    df = _accounts(spark)
    out = retrieval.filter_by_terms(df, {"plan_tier": "PRO", "region": "EU"}, ["timestamp"], 4)
    assert [r.tenure_months for r in out.collect()] == [1, 7, 13, 19]
    assert retrieval.filter_by_terms(df, {}, ["timestamp"]).count() == 20
    assert retrieval.metadata_prefilter({}) is None


def test_hashed_words(spark):
    df = spark.createDataFrame([("Pro pro EU",), (None,), ("",)], "t string")
    first, second, third = [r[0] for r in df.select(hashed_words(64).embed(F.col("t"))).collect()]
    want = [0.0] * 64
    for w in ("pro", "pro", "eu"):
        want[word_bucket(w, 64)] += 1
    assert first == want and not any(second) and not any(third)


def _questions(spark):
    return spark.createDataFrame(
        [("a", "PRO accounts in EU"), ("b", "everything"), ("c", "ENTERPRISE customers"), ("d", "it's FREE")],
        "question_id string, question string",
    )


def test_retrieve(spark):
    df, embedder = _accounts(spark), hashed_words()
    index = retrieval.embed_text(retrieval.build_chunks(df, COMMERCIAL), embedder)
    out = {
        r.question_id: r
        for r in retrieval.retrieve(
            _questions(spark), index, df, COMMERCIAL, embedder, ["timestamp"], k=3
        ).collect()
    }
    assert len(out) == 4
    a = out["a"]
    assert a.filters == {"plan_tier": "PRO", "region": "EU"} and len(a.matched_ids) == 3
    assert [r.tenure_months for r in a.rows] == [1, 7, 13, 19, 25, 31, 37, 43, 49, 55]
    assert a.answer == (
        "Profile 'COMMERCIAL' brief for: 'PRO accounts in EU'\n"
        "  Applied filter: plan_tier=PRO, region=EU\n"
        "  Retrieved 3 matching record(s) from the lakehouse."
    )
    assert [r.tenure_months for r in out["b"].rows] == list(range(20))
    assert "no specific filter" in out["b"].answer
    assert out["c"].matched_ids == [] and out["c"].rows == [] and "Retrieved 0" in out["c"].answer
    assert '"it\'s FREE"' in out["d"].answer


def test_matching_rows_of_several_scopes(spark):
    df = _accounts(spark)
    scopes = spark.createDataFrame([("PRO\x1fEU",), ("*\x1f*",)], "scope string")

    out = retrieval.matching_rows(df, COMMERCIAL, scopes, ["timestamp"], 5).collect()
    found = {r.scope: [x.tenure_months for x in r.rows] for r in out}
    assert found["*\x1f*"] == [0, 1, 2, 3, 4] and set(found) == {"PRO\x1fEU", "*\x1f*"}


def test_plain_numbers_are_printed_without_further_steps(spark):
    numbers = [0.5, -12.25, 1e-5, 12345678.0, 1e300, float("nan"), float("inf"), float("-inf"), None, -1.5e-7]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    shown = df.select(texts.number_text(F.col("x")).alias("t"))
    assert [r.t for r in shown.collect()] == [None if x is None else repr(x) for x in numbers]
    assert "THEN transform(" in shown._jdf.queryExecution().optimizedPlan().toString()


def test_memory_for_word_vectors_does_not_grow_with_the_texts():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tidemark.functions import embedding

    def plain(text):
        words = [w for w in (text or "").lower().replace("-", " ").split(" ") if w]
        return np.bincount([word_bucket(w, 16) for w in words], minlength=16).tolist()

    few = ["One two-two", None, "", "x " * 700_000, "Three one", "é É"]
    assert embedding._word_counter(16).func(pa.array(few)).to_pylist() == [plain(t) for t in few]
    many = pa.array(["alpha beta gamma delta " * 250] * 8000)
    tracemalloc.start()
    embedding._word_counter(16).func(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # 46 MB of text


def test_rows_are_not_dealt_by_scope(spark):
    """The asked scopes' size is not known from the plan, as with a large table of questions."""
    df = _accounts(spark, 400)
    scopes = spark.createDataFrame([("*\x1f*",)] * 50, "scope string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = retrieval.matching_rows(df, COMMERCIAL, scopes, ["timestamp"], 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [[x.tenure_months for x in r.rows] for r in rows] == [[0, 1, 2, 3, 4]]


@pytest.fixture
def sizes_unknown(spark):
    """No table counts as small, as when sizes are large or not known."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _scope_joins(answers):
    """How Bronze rows meet the asked scopes."""
    plan = answers._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"(\w+Join) \[scope#\d+\], \[scope#\d+\], LeftSemi", plan))


def test_ask_does_not_deal_bronze_by_scope(spark, lake, salt, sizes_unknown):
    house = lake(COMMERCIAL)
    medallion.ingest(house, _accounts(spark, 400), salt)
    assistant.build_index(house)
    answers = assistant.ask(house, _questions(spark))
    rows = {r.question_id: [x.tenure_months for x in r.rows] for r in answers.collect()}
    assert _scope_joins(answers) == {"BroadcastHashJoin"}
    assert rows == {"a": list(range(1, 121, 6)), "b": list(range(20)), "c": [], "d": list(range(0, 60, 3))}


def test_the_whole_chain_does_not_deal_bronze_by_scope(spark, lake, salt, sizes_unknown):
    raw = _accounts(spark, 400).fillna("ENTERPRISE", ["plan_tier"])
    report = end_to_end.run(lake(COMMERCIAL), raw, _questions(spark), salt)
    rows = {r.question_id: [x.tenure_months for x in r.rows] for r in report.answers.collect()}
    assert _scope_joins(report.answers) == {"BroadcastHashJoin"}
    assert rows == {"a": list(range(1, 121, 6)), "b": list(range(20)), "c": list(range(2, 62, 3)), "d": list(range(0, 60, 3))}


def test_index_grows_only_by_new_chunks_and_guards_its_model(spark, lake, salt):
    house = lake(COMMERCIAL)
    medallion.ingest(house, _accounts(spark, 10), salt)
    assert assistant.build_index(house) == 10
    assert assistant.build_index(house) == 0
    medallion.ingest(house, _accounts(spark, 14), salt)
    assert assistant.build_index(house) == 14  # rows ingested again are rows of their own
    other = Embedder("other", hashed_words().embed)
    with pytest.raises(assistant.ModelMismatchError):
        assistant.build_index(house, other)
    with pytest.raises(assistant.ModelMismatchError):
        assistant.ask(house, _questions(spark), other)
    assert assistant.ask(house, _questions(spark)).count() == 4


def test_end_to_end(spark, lake, salt):
    raw = _accounts(spark, 30).fillna("ENTERPRISE", ["plan_tier"])
    report = end_to_end.run(lake(COMMERCIAL), raw, _questions(spark), salt)
    assert report.ingested == 30 and report.indexed == 30
    assert report.published["gold.gold_account_health"] == 3
    assert report.answers.count() == 4


def test_equal_rows_are_chunks_of_their_own(spark, lake, salt):
    from tidemark.plans import assistant

    house = lake(COMMERCIAL)
    questions = spark.createDataFrame([("q", "PRO accounts in EU")], "question_id string, question string")
    before = assistant.ask(house, questions).first()
    assert before.matched_ids == [] and before.rows == []
    one = _accounts(spark, 3)
    rows = one.union(one)
    ids = [r.id for r in retrieval.build_chunks(rows, COMMERCIAL).collect()]
    assert len(set(ids)) == 6 and sum(i.endswith("-2") for i in ids) == 3
    house.append_product("bronze", COMMERCIAL.bronze_table, rows, COMMERCIAL.schema)
    assert assistant.build_index(house) == 6 and assistant.build_index(house) == 0


def test_a_row_repeated_very_often_spreads_over_tasks(spark):
    one = _accounts(spark, 2)
    hot = one.limit(1).crossJoin(spark.range(300_000).select(F.lit(1).alias("n"))).drop("n")
    # "None" written out and no value give the same text, but are different rows.
    named = one.limit(1).withColumn("region", F.lit("None"))
    rows = hot.unionByName(one).unionByName(named).unionByName(named.withColumn("region", F.lit(None).cast("string")))
    found = retrieval.with_chunk_id(rows, COMMERCIAL)
    assert found.count() == 300_004 and found.select("id").distinct().count() == 300_004
    numbers = found.select(F.regexp_extract("id", "-([0-9]+)$", 1).alias("n")).where("n <> '' and length(n) < 10")
    assert numbers.agg(F.max(F.col("n").cast("int"))).first()[0] == 300_001
    per_task = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 200_000
    assert found.where("region is null").count() == 1 and found.where("region = 'None'").count() == 1


def test_terms_in_one_pass(spark):
    """Overlapping terms, terms that begin another, letters that mean others, and one folding of the text."""
    from tidemark.functions.text import extract_terms

    words = {
        "model": ("Optimus", "Optimus-Gen2", "Gen2"), "place": ("West", "EU West", "EU", "-a", "Été", "KS"), "none": ("absent",),
    }
    cases = {
        "Optimus-Gen2 in EU West": {"model": "Optimus", "place": "West"},
        "in optimus gen2x": {"model": "Optimus"},
        "gen2, euro": {"model": "Gen2"},
        "(EU) x-a revenue": {"place": "EU"},
        "x-a": {"place": "-a"},
        "-a": {},
        "ÉTÉ Kſ": {"place": "Été"},
        "Kſ!": {"place": "KS"},
        "éEU EU_ absently": {},
        "": {},
        None: {},
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    found = df.select("text", extract_terms(F.col("text"), words).alias("found"))
    assert {r.text: r.found for r in found.collect()} == cases
    plan = found.select("found")._jdf.queryExecution().optimizedPlan().toString()
    plain = df.select(extract_terms(F.col("text"), {"a": ("x", "y", "z"), "b": ("v", "w")}).alias("f"))
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1 and plan.count("regexp_extract_all(") == 1
