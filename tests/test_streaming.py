import datetime as dt
import json

from pyspark.sql import functions as F

from corpuskit.streaming import feedback as sfb
from corpuskit.streaming import ingest
from corpuskit.streaming import requests as sr

T0 = dt.datetime(2024, 1, 1)
LOG = "ts timestamp, endpoint string, status int, duration_s double, user_id long"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).parquet(str(folder))


def test_dedup_remembers_earlier_runs(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def run(name, bodies):
        (source / name).write_text("\n".join(json.dumps({"body": b}) for b in bodies) + "\n{bad\n\n")
        cleaned = ingest.stream_clean(ingest.stream_records(ingest.stream_lines(spark, str(source))))
        table = ingest.write_available(ingest.stream_dedup(cleaned).select("body"), out, "dedup")
        return sorted(r.body for r in table.collect())

    assert run("1", ["<p>a</p>", "a", "b"]) == ["a", "b"]
    assert run("2", ["b ", "c"]) == ["a", "b", "c"]


def test_bounded_dedup(spark, tmp_path):
    schema = "body string, parsed_content string, ts timestamp"
    add(spark, tmp_path / "in", [("a", "", at(0)), ("a", "", at(1)), ("b", "", at(2))], schema)
    kept = ingest.stream_dedup(stream(spark, tmp_path / "in", schema), "ts", "10 minutes").select("body")
    table = ingest.write_available(kept, str(tmp_path / "out"), "dedup")
    assert sorted(r.body for r in table.collect()) == ["a", "b"]


def run_windows(spark, tmp_path, slide=None):
    windows = sr.stream_windows(stream(spark, tmp_path / "log", LOG), slide=slide)
    return ingest.write_available(windows, str(tmp_path / f"w{slide}"), "windows")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    def rows(*minutes):
        return [(at(m), "/g", 500 if m % 2 else 200, 0.2, 1) for m in minutes]

    add(spark, tmp_path / "log", rows(0, 1, 2, 30), LOG)
    assert run_windows(spark, tmp_path).count() == 1
    add(spark, tmp_path / "log", rows(3, 31, 90), LOG)  # minute 3 is behind the watermark
    table = run_windows(spark, tmp_path)
    got = {r.window_start: (r.requests, r.errors) for r in table.collect()}
    assert got == {at(0): (3, 1), at(30): (2, 1)}
    batch = spark.read.schema(LOG).parquet(str(tmp_path / "log"))
    assert tuple(sr.late_rows(batch, table).first()) == (6, 1)


def test_sliding_stream_equals_batch(spark, tmp_path, sf):
    from corpuskit.catalogue.inputs import request_log
    from corpuskit.operators import requests as rq

    log = request_log(spark, sf)
    log.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "log"))
    schema = spark.read.parquet(str(tmp_path / "log")).schema
    streamed = ingest.write_available(
        sr.stream_windows(stream(spark, tmp_path / "log", schema)), str(tmp_path / "out"), "windows"
    ).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint", "requests", "errors",
             F.round("p95", 9).alias("p95"))
    windows = rq.sliding(rq.minute_counts(log))
    batch = windows.join(rq.latency_quantiles(windows), ["window_start", "endpoint"]).select(
        "window_start", "endpoint", "requests", "errors", F.round("p95", 9).alias("p95"))
    last = streamed.agg(F.max("window_start")).first()[0]
    closed = batch.filter(F.col("window_start") <= F.lit(last).cast("timestamp_ntz"))
    assert streamed.count() > 100
    assert streamed.exceptAll(closed).count() == 0 and closed.exceptAll(streamed).count() == 0


def test_alert_state_survives_batches(spark, tmp_path):
    schema = "endpoint string, ts timestamp, error_ratio double"

    def run(rows):
        add(spark, tmp_path / "in", [("/g", at(m), v) for m, v in rows], schema)
        states = sr.stream_alerts(stream(spark, tmp_path / "in", schema), F.col("error_ratio") > 0.05, 2)
        table = ingest.write_available(states, str(tmp_path / "out"), "alerts")
        return "".join(r.state[0] for r in table.orderBy("ts").collect())

    assert run([(1, 0.5), (0, 0.0)]) == "ip"
    assert run([(2, 0.5), (3, 0.5)]) == "ippf"
    # After minute 5 nothing comes for a while: inactive from minute 6 on.
    assert run([(4, None), (5, 0.2), (8, 0.2)]) == "ippfipip"


def test_silent_series_end_by_timer(spark, tmp_path):
    """A series that is heard of no more goes inactive once the watermark shows it; its state goes with the timer."""
    schema = "endpoint string, ts timestamp, error_ratio double"

    def run(rows):
        add(spark, tmp_path / "in", [(s, at(m), v) for s, m, v in rows], schema)
        states = sr.stream_alerts(stream(spark, tmp_path / "in", schema), F.col("error_ratio") > 0.05, 2)
        table = ingest.write_available(states, str(tmp_path / "out"), "alerts")
        return {s: "".join(r.state[0] for r in table.filter(F.col("endpoint") == s).orderBy("ts").collect()) for s in "abc"}

    assert run([("a", 0, 0.5), ("b", 0, 0.5), ("b", 1, 0.5), ("c", 0, 0.0)]) == {"a": "pi", "b": "pp", "c": "i"}
    assert run([("a", 9, 0.0)]) == {"a": "pii", "b": "ppi", "c": "i"}
    # Too late for b, as the watermark is at minute 9; a new run for c.
    assert run([("b", 2, 0.5), ("c", 12, 0.5)]) == {"a": "pii", "b": "ppi", "c": "ip"}


def test_late_rows_are_set_aside(spark, tmp_path):
    sink = sr.LateQuarantine(str(tmp_path / "out"))

    def run(*minutes):
        add(spark, tmp_path / "log", [(None if m is None else at(m), "/g", 200, 0.1, m) for m in minutes], LOG)
        ingest.feed_available(stream(spark, tmp_path / "log", LOG), sink, str(tmp_path / "progress"))
        return [sorted(-1 if r.user_id is None else r.user_id for r in sink.rows(spark.createDataFrame([], LOG), part).collect()) for part in ("late", "on_time")]

    assert run(0, 3, 30) == [[], [0, 3, 30]]
    # The watermark is at minute 20.
    assert run(4, 14, 15, 21, None) == [[-1, 4, 14, 15], [0, 3, 21, 30]]
    batch = spark.createDataFrame([(at(4), "/g", 200, 0.1, 4), (at(22), "/g", 200, 0.1, 22)], LOG)
    sink(batch, 1)  # a batch that runs again replaces its rows
    assert [sorted(r.user_id for r in sink.rows(batch, part).collect()) for part in ("late", "on_time")] == [[4], [0, 3, 22, 30]]


def test_feedback_meets_queries_that_come_later(spark, tmp_path):
    asked, given = "id long, request_id string, timestamp timestamp", "id long, request_id string, is_helpful boolean, timestamp timestamp"

    def run(queries, feedback):
        add(spark, tmp_path / "q", queries, asked)
        add(spark, tmp_path / "f", feedback, given)
        pairs = sfb.feedback_pairs(stream(spark, tmp_path / "f", given), stream(spark, tmp_path / "q", asked), "1 hour", "10 minutes", "30 minutes")
        table = ingest.write_available(pairs, str(tmp_path / "out"), "pairs")
        return {r.id: (r.query_id, r.is_orphan) for r in table.collect()}

    first = run([(1, "a", at(0)), (7, "a", at(1))], [(10, "a", True, at(2)), (11, "b", True, at(3)), (12, None, True, at(3)), (13, "x", False, at(3))])
    assert first == {10: (1, False)}
    second = run([(2, "b", at(1)), (3, None, at(2))], [(14, "a", False, at(20)), (15, "b", False, at(200))])
    assert second == {10: (1, False), 11: (2, False), 14: (1, False)}
    # Both streams are hours on: what found no query is told as such, also what came too long after it.
    last = run([(9, "z", at(900))], [(16, "z", True, at(901))])
    assert last == second | {12: (None, True), 13: (None, True), 15: (None, True), 16: (9, False)}


def test_state_of_a_join_is_one_store(spark, tmp_path, monkeypatch):
    asked, given = "id long, request_id string, timestamp timestamp", "id long, request_id string, timestamp timestamp"

    def run(name, k):
        add(spark, tmp_path / name / "q", [(k, f"r{k}", at(k))], asked)
        add(spark, tmp_path / name / "f", [(k, f"r{k + 1}", at(k)), (-k, f"r{k}", at(k))], given)
        pairs = sfb.feedback_pairs(stream(spark, tmp_path / name / "f", given), stream(spark, tmp_path / name / "q", asked))
        table = ingest.write_available(pairs, str(tmp_path / name / "out"), "pairs")
        return sorted((r.id, r.query_id) for r in table.collect()), {p.name for p in (tmp_path / name).rglob("*-keyToNumValues")}

    assert run("new", 1) == ([(-1, 1)], set())
    assert run("new", 2) == ([(-2, 2), (-1, 1), (1, 2)], set())
    four = {"left-keyToNumValues", "right-keyToNumValues"}
    with monkeypatch.context() as before:
        before.setitem(ingest.STATE, "spark.sql.streaming.join.stateFormatVersion", "2")
        assert run("old", 1) == ([(-1, 1)], four)
    # What began with four stores goes on with them.
    assert run("old", 2) == ([(-2, 2), (-1, 1), (1, 2)], four)


def test_hot_request_is_spread(spark, tmp_path):
    asked, given = "id long, request_id string, timestamp timestamp", "id long, request_id string, timestamp timestamp"
    add(spark, tmp_path / "q", [(1, "a", at(0))], asked)
    add(spark, tmp_path / "f", [(i, "a" if i % 2 else None, at(1)) for i in range(400)] + [(999, "z", at(900))], given)
    add(spark, tmp_path / "q", [(2, "z", at(900))], asked)
    pairs = sfb.feedback_pairs(stream(spark, tmp_path / "f", given), stream(spark, tmp_path / "q", asked))
    table = ingest.write_available(pairs.withColumn("task", F.spark_partition_id()), str(tmp_path / "out"), "pairs")
    assert table.count() == 401 and table.filter("is_orphan").count() == 200
    assert table.filter("query_id = 1").select("task").distinct().count() > 2
    assert table.filter("is_orphan").select("task").distinct().count() > 2


def test_queries_of_a_batch_share_rows_of_state(spark, tmp_path):
    asked, given = "id long, request_id string, timestamp timestamp", "id long, request_id string, timestamp timestamp"
    near = F.pmod(F.hash(F.col("id").cast("string")), F.lit(100_800)) < 10
    ids = sorted(r.id for r in spark.range(2_000_000).filter(near).collect())
    assert len(ids) > 100
    late = set(ids[::10])
    runs = [
        ([(i, str(i), at(k % 50)) for k, i in enumerate(ids) if i not in late], [(i, str(i), at(k % 50)) for k, i in enumerate(ids)]),
        ([(i, str(i), at(k % 50)) for k, i in enumerate(ids) if i in late], [(-1 - i, f"no{i}", at(9)) for i in ids]),
        ([(-1, "closing", at(9_000))], [(-1, "closing", at(9_000))]),
    ]
    ingest.keep_state_on_disk(spark)
    rows = []
    for queries, feedback in runs:
        add(spark, tmp_path / "q", queries, asked)
        add(spark, tmp_path / "f", feedback, given)
        pairs = sfb.feedback_pairs(stream(spark, tmp_path / "f", given), stream(spark, tmp_path / "q", asked))
        out = pairs.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
        query = out.trigger(availableNow=True).start()
        query.awaitTermination()
        rows.append(query.recentProgress[0]["stateOperators"][0]["numRowsTotal"])
    # Ten buckets of eight shares, in at most two slots of time, beside the feedback.
    assert rows[0] - len(ids) <= 160 < len(ids) * 4 and rows[1] - 2 * len(ids) <= 320
    told = {r.id: (r.query_id, r.is_orphan) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert told == {i: (i, False) for i in ids} | {-1 - i: (None, True) for i in ids if i} | {-1: (-1, False)}


def test_rows_of_queries_stay_as_long_as_their_last(spark, tmp_path):
    asked, given = "id long, request_id string, timestamp timestamp", "id long, request_id string, timestamp timestamp"
    micro = dt.timedelta(microseconds=1)

    def run(queries, feedback):
        add(spark, tmp_path / "q", queries, asked)
        add(spark, tmp_path / "f", feedback, given)
        pairs = sfb.feedback_pairs(stream(spark, tmp_path / "f", given), stream(spark, tmp_path / "q", asked), "1 hour", "10 minutes", "30 minutes", buckets=1)
        table = ingest.write_available(pairs, str(tmp_path / "out"), "pairs")
        return {r.id: (r.query_id, r.query_time) for r in table.collect()}

    queries = [(k, f"r{k}", at(k)) for k in range(-200, 150)] + [(500, "none", None), (501, None, at(0))]
    told = run(queries, [(1, "r0", at(60)), (2, "r0", at(-10)), (3, "r0", at(60) + micro), (4, "r0", at(-10) - micro), (5, "none", at(0)), (6, "r149", at(149))])
    want = {1: (0, at(0)), 2: (0, at(0)), 6: (149, at(149)), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert told == want
    # The watermark is at minute 119: the last of the queries can still get feedback, for which the first are too old.
    told = run([(600, "r600", at(149))], [(7, "r100", at(150)), (8, "r148", at(150)), (9, "r80", at(150))])
    want |= {7: (100, at(100)), 8: (148, at(148))}
    assert told == want
    told = run([(601, "r601", at(180))], [(10, "r149", at(190)), (11, "r145", at(200))])
    want |= {10: (149, at(149)), 11: (145, at(145))}
    assert told == want
    told = run([(602, "r602", at(9_000))], [(12, "r602", at(9_000))])
    assert told == want | {9: (None, None), 12: (602, at(9_000))}


def test_queries_are_packed_by_bucket_and_slot(monkeypatch):
    import pyarrow as pa

    rows = [(k, 7 * k, k % 3 - 1, k // 40, 1_000 - k) for k in range(100)]
    names = ["_request", "query_id", "_bucket", "_slot", "query_time"]
    columns = [pa.array([str(r[0]) for r in rows]), *[pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)], pa.array([r[4] for r in rows], pa.timestamp("us", "UTC"))]
    batches = pa.table(dict(zip(names, columns))).to_batches(max_chunksize=7)
    for held in (1, 1 << 20):
        monkeypatch.setattr(sfb, "_HELD_BYTES", held)
        got = pa.Table.from_batches(sfb._packed(iter([*batches, batches[0].slice(0, 0)]))).to_pylist()
        assert len(got) == (9 if held > 1 else len({(i // 7, r[2], r[3]) for i, r in enumerate(rows)}))
        assert all(g["_first"] == min(g["_times"]) for g in got)
        flat = [(q, i, g["_bucket"], t) for g in got for q, i, t in zip(g["_requests"], g["_ids"], g["_times"])]
        want = [(q, i, b, t) for q, i, b, t in zip(*[pa.table(dict(zip(names, columns)))[n].to_pylist() for n in ("_request", "query_id", "_bucket", "query_time")])]
        assert sorted(flat) == sorted(want)
    assert [b.num_rows for b in sfb._packed(iter([batches[0].slice(0, 0)]))] == []


def test_orphans_are_marked(spark, tmp_path):
    queries = spark.createDataFrame([(1, "r", at(0))], "id long, request_id string, timestamp timestamp")
    schema = "id long, request_id string"
    add(spark, tmp_path / "in", [(5, "r"), (6, "x"), (7, None)], schema)
    first = sfb.join_feedback(stream(spark, tmp_path / "in", schema), queries, str(tmp_path / "out"))
    want = {(5, 1, False), (6, None, True), (7, None, True)}
    assert {(r.id, r.query_id, r.is_orphan) for r in first.collect()} == want
    add(spark, tmp_path / "in", [(8, "r")], schema)
    both = sfb.join_feedback(stream(spark, tmp_path / "in", schema), queries, str(tmp_path / "out"))
    assert {(r.id, r.query_id, r.is_orphan) for r in both.collect()} == want | {(8, 1, False)}


def test_sessions_close_after_the_gap(spark, tmp_path):
    add(spark, tmp_path / "log", [(at(m), "/g", 200, 0.1, 1) for m in (0, 20, 45, 100, 300)], LOG)
    table = ingest.write_available(sfb.stream_sessions(stream(spark, tmp_path / "log", LOG)), str(tmp_path / "out"), "s")
    assert sorted((r.session_start, r.requests) for r in table.collect()) == [(at(0), 3), (at(100), 1)]


ASKED = "id long, request_id string, timestamp timestamp, user_id string, response_time_ms int"


def test_daily_refresh_updates_and_repeats(spark, tmp_path):
    given = "id long, request_id string, is_helpful boolean, timestamp timestamp"
    folder = str(tmp_path / "refresh")

    def run(queries, feedback):
        add(spark, tmp_path / "q", queries, ASKED)
        add(spark, tmp_path / "f", feedback, given)
        daily = sfb.refresh_daily(stream(spark, tmp_path / "q", ASKED), stream(spark, tmp_path / "f", given), folder, within="2 days", watermark="2 days")
        return {str(r.date): tuple(r)[:5] for r in daily.collect()}

    # Feedback on r3 comes before its query.
    votes = [(1, "r1", True, at(2)), (2, "r1", False, at(2)), (3, "none", True, at(2)), (4, "r3", True, at(3))]
    first = run([(1, "r1", at(0), "a", 10), (2, "r2", at(1), "b", 20)], votes)
    assert first == {"2024-01-01": (2, 15.0, 2, 1, 1)}
    later = [(3, "r3", at(2), "a", 30), (4, "r4", at(1500), "c", 5)]
    second = {"2024-01-01": (3, 20.0, 2, 2, 2), "2024-01-02": (1, 5.0, 1, 1, 0)}
    assert run(later, [(5, "r2", False, at(4)), (6, "r4", True, at(1501))]) == second
    sfb.DailyRefresh(folder).queries(spark.createDataFrame(later, ASKED), 1)
    again = [("r3", True, 3, at(2), False), ("r2", False, 2, at(1), False), ("r4", True, 4, at(1500), False)]
    pairs = "request_id string, is_helpful boolean, query_id long, query_time timestamp, is_orphan boolean"
    written = {int(p.name.split("=")[1]) for p in (tmp_path / "refresh" / "partial").glob("date=*/kind=feedback/batch=*")}
    sfb.DailyRefresh(folder).pairs(spark.createDataFrame(again, pairs), max(written))
    sfb.DailyRefresh(folder).queries(spark.createDataFrame([], ASKED), 9)
    assert {str(r.date): tuple(r)[:5] for r in sfb.DailyRefresh(folder).table(spark).collect()} == second


def test_feedback_before_any_query(spark, tmp_path):
    sink = sfb.DailyRefresh(str(tmp_path))
    pairs = "is_helpful boolean, query_time timestamp, is_orphan boolean"
    sink.pairs(spark.createDataFrame([(True, at(0), False), (True, None, True)], pairs), 0)
    sink.queries(spark.createDataFrame([], ASKED), 0)
    assert sink.table(spark).count() == 0
    sink.queries(spark.createDataFrame([(1, "r", at(0), "a", 10)], ASKED), 1)
    assert [tuple(r)[:5] for r in sink.table(spark).collect()] == [(1, 10.0, 1, 1, 0)]


def test_only_near_queries_are_read(spark, tmp_path):
    rows = [(i, f"r{i}", at(60 * i)) for i in range(100)]
    queries = spark.createDataFrame(rows, "id long, request_id string, timestamp timestamp")
    schema = "id long, request_id string, timestamp timestamp"
    batch = spark.createDataFrame([(1, "r50", at(60 * 50 + 5)), (2, "r1", at(60 * 50 + 6))], schema)
    sink = sfb.FeedbackJoin(queries, str(tmp_path / "out"), within="2 hours")
    assert sink._near(batch).count() == 2
    sink(batch, 0)
    got = {r.id: r.query_id for r in spark.read.parquet(sink.folder).collect()}
    assert got == {1: 50, 2: None}  # dated too long after its query


def test_top_questions_need_a_proof(spark, tmp_path):
    from corpuskit.operators.feedback import top_questions
    from corpuskit.streaming import frequent

    rows = [(f"q{i % 300}" if i % 3 else f"hot{i % 5}",) for i in range(6_000)] + [(None,)] * 5
    asked = spark.createDataFrame(rows, "query_text string").repartition(4)
    want = [tuple(r) for r in top_questions(asked.filter("query_text is not null"), 7).collect()]
    for tracked in (4, 64, 2_000):
        sink = frequent.FrequentQuestions(str(tmp_path / str(tracked)), tracked)
        for part in range(3):
            sink(asked.filter(F.abs(F.hash("query_text")) % 3 == part), part)
        sink(asked.filter(F.abs(F.hash("query_text")) % 3 == 2), 2)
        assert [tuple(r) for r in sink.top(asked, 7).collect()] == want
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "query_text string")
    sink = frequent.FrequentQuestions(str(tmp_path / "few"), 10)
    sink(few, 0)
    assert [tuple(r) for r in sink.top(few, 7).collect()] == [("a", 2), ("b", 1)]
