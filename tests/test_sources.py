import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpuskit.operators import quality
from corpuskit.sources import lines as ln
from corpuskit.sources import store

LINES = [
    ('{"body":"a","parsed_content":"b"}', ("a", "b"), None),
    ('  {"body":"a"}\t', ("a", ""), None),
    ('{"body":"x","body":"y"}', ("y", ""), None),
    ('{"body":null,"other":[1]}', ("", ""), None),
    ("{}", ("", ""), None),
    ('﻿{"body":"m"}', ("m", ""), None),
    ('{"body": 1, "x": NaN}', ("1", ""), None),
    ('{"a":1} junk', None, "malformed_json"),
    ('{"a":1} {"b":2}', None, "malformed_json"),
    ('{"a":1}, {"b":2}', None, "malformed_json"),
    ("{bad", None, "malformed_json"),
    ("{'body':'x'}", None, "malformed_json"),
    ('{"body":"a"}]', None, "malformed_json"),
    ("1", None, "not_an_object"),
    ("[1]", None, "not_an_object"),
    ("null", None, "not_an_object"),
    ('"s"', None, "not_an_object"),
    ("word", None, "malformed_json"),
]


def test_lines_become_records(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(LINES)] + [(99, "   "), (98, "")], "line_no int, value string")
    parsed = ln.parse_lines(df)
    records = {r.line_no: (r.body, r.parsed_content) for r in ln.records(parsed).collect()}
    rejected = {r.line_no: r.reject_reason for r in ln.quarantine(parsed).collect()}
    assert records == {i: v[1] for i, v in enumerate(LINES) if v[1] is not None}
    assert rejected == {i: v[2] for i, v in enumerate(LINES) if v[2] is not None}
    assert ln.line_count(df).first()[0] == len(LINES)


@pytest.mark.parametrize("encoding", ["utf-8", "euc-kr", "latin-1"])
def test_encodings_and_order(spark, tmp_path, encoding):
    bodies = [f"{i}é" if encoding == "latin-1" else f"{i}안녕" for i in range(50)]
    if encoding == "euc-kr":
        bodies = [f"{i}안녕" for i in range(50)]
    text = "\n".join(json.dumps({"body": b}, ensure_ascii=False) for b in bodies)
    (tmp_path / "a.jsonl").write_bytes(text.encode(encoding))
    read = ln.records(ln.parse_lines(ln.read_lines(spark, str(tmp_path / "a.jsonl"), encoding)))
    assert [r.body for r in read.orderBy("line_key").collect()] == bodies


def test_utf16(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes('{"body":"é"}\n{bad\n[1]\n'.encode("utf-16-le"))
    parsed = ln.read_wide_records(spark, str(tmp_path / "a.jsonl"), "UTF-16LE")
    assert [r.body for r in ln.records(parsed).collect()] == ["é"]
    assert ln.quarantine(parsed).count() == 2
    with pytest.raises(ValueError):
        ln.read_lines(spark, str(tmp_path), "utf-16")


def test_undecodable_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"body":"a"}\n{"body":"\xff\xfe"}\n')
    parsed = ln.parse_lines(ln.read_lines(spark, str(tmp_path / "a.jsonl")))
    assert [r.reject_reason for r in ln.quarantine(parsed).collect()] == ["undecodable"]
    assert ln.records(parsed).count() == 1


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ln.read_lines(spark, str(tmp_path / "none"))


def test_limits(spark):
    df = spark.range(5)
    assert ln.first_rows(df, 0).count() == 0
    assert ln.first_rows(df, None).count() == 5
    assert [r.id for r in ln.first_rows(df, 2, "id").collect()] == [0, 1]


def test_report_keeps_non_ascii(spark, tmp_path):
    report = spark.createDataFrame([("훈련", 1)], "split string, rows int")
    store.save_report(report, str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ['{"split":"훈련","rows":1}']


def test_split_folders(spark, tmp_path):
    df = spark.createDataFrame([("train", 1), ("test", 2)], "split string, x int")
    store.save_splits(df, str(tmp_path / "d"))
    back = store.load_splits(spark, str(tmp_path / "d"))
    assert {(r.split, r.x) for r in back.collect()} == {("train", 1), ("test", 2)}
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_csv_export_survives_quotes_and_newlines(spark, tmp_path):
    rows = [(1, 'say "hi", ok'), (2, "two\nlines")]
    store.export(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "c"))
    back = spark.read.options(header="true", escape='"', multiLine="true").schema("id int, t string").csv(str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_stage_counts_by_reason(spark):
    raw = ['{"body":"a"}', '{"body":"a"}', '{"body":""}', '{"body":"","parsed_content":"p"}', "{bad", "  ", "[1]"]
    df = spark.createDataFrame(list(enumerate(raw)), "line_no int, value string")
    body, extra = F.col("record.body"), F.coalesce("record.parsed_content", F.lit(""))
    from corpuskit.functions.text import training_text

    counts = quality.stage_counts(df, ln.parse_lines(df), body, training_text(body, extra), F.col("line_no"))
    assert {r.stage: r.rows for r in counts.collect()} == {
        "lines": 7, "blank": 1, "not_blank": 6, "rejected": 2, "records": 4, "duplicate": 2, "empty": 1, "training_rows": 1,
    }


def test_line_order_over_many_blocks(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(f'{{"body":"{name}{i:04d}"}}' for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = ln.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        read = ln.records(ln.parse_lines(lines)).orderBy("line_key").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.body for r in read] == [f"{n}{i:04d}" for n in "ab" for i in range(400)]


def test_build_from_files(spark, tmp_path):
    from corpuskit.plans import corpus

    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"body": f"text {i % 40}"}) for i in range(80)))
    built = corpus.build(ln.read_lines(spark, str(tmp_path / "a.jsonl")), "line_key")
    assert built.encoded.count() == 40
    kept = built.encoded.orderBy("line_key").select("line_key.seq").collect()
    assert [r.seq for r in kept] == list(range(40))
