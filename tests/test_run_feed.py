import json

from tidemark.sources.run_results import read_run_results
from tidemark.streaming.run_feed import read_feed_results, read_quarantine, stream_run_results

GOOD = {"results": [{"unique_id": "a", "status": "ok", "execution_time": 1.5}, {"unique_id": None, "status": "error"}]}
BAD = {
    "cut.json": (json.dumps(GOOD)[:-4], "malformed"),
    "empty.json": ("", "malformed"),
    "null.json": ("null", "malformed"),
    "list.json": ("[1, 2]", "malformed"),
    "type.json": ('{"results": [{"unique_id": "x", "execution_time": "soon"}]}', "malformed"),
    "tail.json": (json.dumps(GOOD) + " and more", "malformed"),
    "brace.json": (json.dumps(GOOD) + "}", "malformed"),
    "two.json": (json.dumps(GOOD) + "\n" + json.dumps(GOOD), "malformed"),
    "list_end.json": (json.dumps(GOOD) + "] [" + json.dumps(GOOD), "malformed"),
    "object_end.json": (json.dumps(GOOD) + '} {"d": ' + json.dumps(GOOD), "malformed"),
    "none.json": ('{"metadata": {}}', "no results"),
    "text.json": ("not json   at all \U0001f40b", "malformed"),
}


def _run(spark, base, **options):
    stream_run_results(
        spark, str(base / "in"), str(base / "out"), str(base / "checkpoint"), "ROBOTICS", once=True, **options
    ).awaitTermination()


def _name(row):
    return row["file"].rsplit("/", 1)[-1]


def test_good_arrive_bad_are_kept_whole(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.json").write_text(json.dumps(GOOD, indent=2) + "\n")
    (source / "idle.json").write_text('{"results": []}')
    for name, (text, _) in BAD.items():
        (source / name).write_text(text, encoding="utf-8")
    _run(spark, tmp_path, files=3)
    results = read_feed_results(spark, str(tmp_path / "out"))
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "good.json").write_text(json.dumps(GOOD, indent=2))
    wanted = read_run_results(spark, str(plain), "ROBOTICS")
    assert results.columns == wanted.columns
    assert sorted(map(str, results.drop("file").collect())) == sorted(map(str, wanted.drop("file").collect()))
    bad = {_name(r): (r["document"], r["reason"]) for r in read_quarantine(spark, str(tmp_path / "out")).collect()}
    # Spark's text source gives no row for a file without a byte: there is nothing to lose.
    assert bad | {"empty.json": BAD["empty.json"]} == BAD


def test_restart_reads_new_files_only(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [json.dumps(GOOD), "{", json.dumps(GOOD), "", '{"results": null}']
    (source / "one.json").write_text("\n".join(lines))
    _run(spark, tmp_path, one_per_line=True)
    _run(spark, tmp_path, one_per_line=True)
    assert read_feed_results(spark, str(tmp_path / "out")).count() == 4
    assert read_quarantine(spark, str(tmp_path / "out")).count() == 3
    (source / "two.json").write_text(json.dumps(GOOD))
    _run(spark, tmp_path, one_per_line=True)
    assert read_feed_results(spark, str(tmp_path / "out")).count() == 6
    assert read_quarantine(spark, str(tmp_path / "out")).count() == 3


def test_results_do_not_read_the_quarantine(spark, tmp_path, capsys):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.json").write_text(json.dumps(GOOD))
    (source / "bad.json").write_text("{")
    _run(spark, tmp_path)
    read_feed_results(spark, str(tmp_path / "out")).explain()
    assert "PartitionFilters: [isnotnull(quarantined" in capsys.readouterr().out
