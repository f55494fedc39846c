"""Running values over hot keys, mergeable summaries, seen-set filters, bucket digests and counted ingests."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuskit.operators import alerts, conversation, dedup, evaluation, scan, seen, sketches, versions
from corpuskit.operators.skew import skewed_join
from corpuskit.operators.vocabulary import first_of, learn_vocabulary
from corpuskit.plans.ingest import ingest
from corpuskit.session import durable

T0 = dt.datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def series(spark):
    """One series with most of the steps, some short ones, one without a name."""
    n = spark.range(6_000)
    name = F.when(F.col("id") < 5_000, "hot").when(F.col("id") < 5_900, F.concat(F.lit("s"), F.col("id") % 70))
    return n.select(name.alias("k"), F.col("id").alias("at"), (F.xxhash64("id") % 100).alias("v"))


@pytest.mark.parametrize("before", [False, True])
def test_running_equals_window(series, before):
    values = {"total": ("sum", F.col("v")), "most": ("max", F.col("v")), "mixed": ("xor", F.col("v"))}
    ranged = scan.in_ranges(series, ["k"], ["at"], 13)
    got = scan.running(ranged, values, before).drop(scan.RANGE)
    over = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    want = series.select("*", F.sum("v").over(over).alias("total"), F.max("v").over(over).alias("most"), F.bit_xor("v").over(over).alias("mixed"))
    assert same(got, want)


def test_previous_equals_lag(series):
    got = scan.previous(scan.in_ranges(series, ["k"], ["at"], 13, last=["v"]), {"before": "at", "was": "v"}).rows.drop(scan.RANGE)
    over = Window.partitionBy("k").orderBy("at")
    assert same(got, series.select("*", F.lag("at").over(over).alias("before"), F.lag("v").over(over).alias("was")))


def test_running_ignores_nulls_and_keeps_names(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None)], "k int, at int, v long")
    got = scan.running(scan.in_ranges(df, ["k"], ["at"], 3), {"v": ("sum", F.col("v"))}).orderBy("at").collect()
    assert [r.v for r in got] == [None, 5, 5]
    none = df.limit(0)
    assert scan.numbered(none, ["k"], ["at"], "n").count() == 0


def test_a_long_series_is_spread(spark):
    """A million steps of one series: no range is more than twice the median."""
    ranged = scan.in_ranges(spark.range(1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("at")), ["k"], ["at"], 8)
    sizes = sorted(r["count"] for r in ranged.rows.groupBy(scan.RANGE).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    last = scan.running(ranged, {"n": ("sum", F.lit(1).cast("bigint"))}).agg(F.max("n"), F.sum(F.col("n") - F.col("at"))).first()
    assert tuple(last) == (1_000_000, 1_000_000)


def test_blocks_hold_the_rows_before(series):
    dealt = scan.blocks_with_rows_before(series, ["k"], ["at"], 5, block=64)
    assert dealt.groupBy("k", "_block").count().agg(F.max("count")).first()[0] <= 69
    over = Window.partitionBy("k", "_block").orderBy("_n").rowsBetween(-5, -1)
    got = dealt.withColumn("s", F.sum("v").over(over)).filter(~F.col("_lead")).select("k", "at", "s")
    plain = series.select("k", "at", F.sum("v").over(Window.partitionBy("k").orderBy("at").rowsBetween(-5, -1)).alias("s"))
    assert same(got, plain)


def test_zscore_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(scan.blocks_with_rows_before, "__defaults__", (16, None))
    daily = spark.range(300).select(F.expr("date '2024-01-01' + int(id)").alias("d"), (F.xxhash64("id") % 50).alias("n"))
    before = Window.orderBy("d").rowsBetween(-7, -1)
    plain = daily.select("d", "n", F.round((F.col("n") - F.avg("n").over(before)) / F.stddev_samp("n").over(before), 9).alias("z"))
    got = alerts.trailing_zscore(daily, [], "d", "n").select("d", "n", F.round("zscore", 9).alias("z"))
    assert same(got, plain)


def test_sustained_across_ranges(spark):
    rng = random.Random(5)
    met = [rng.random() < 0.9 for _ in range(3_000)]
    minutes = [m for m in range(3_100) if m % 31 != 7][: len(met)]
    rows = [(T0 + dt.timedelta(minutes=m), v) for m, v in zip(minutes, met)]
    got = alerts.sustained(spark.createDataFrame(rows, "ts timestamp_ntz, met boolean"), [], "ts", F.col("met"), 10).orderBy("ts").collect()
    since = last = None
    for r, m, v in zip(got, minutes, met):
        since = None if not v else m if since is None or m - last > 1 else since
        last = m
        assert r.state == ("inactive" if since is None else "firing" if m - since >= 10 else "pending")


def test_offsets_cut_the_transcript(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "höllo\nthere"), (1, 2, "user", None), (1, 3, "user", ""), (1, 4, "assistant", "x"), (2, 5, "assistant", "alone")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = sorted(conversation.with_offsets(turns).collect(), key=lambda r: (r.conv_id, r.turn))
    for conv in (1, 2):
        transcript = "\n".join(r.line for r in lines if r.conv_id == conv and r.line is not None)
        want = {r.turn: r.history for r in conversation.with_history(turns).filter(F.col("conv_id") == conv).collect()}
        for r in lines:
            if r.conv_id == conv:
                assert transcript[: max(r.start - 1, 0)] == want[r.turn]
                assert r.line is None or transcript[r.start : r.end] == r.line
    asked = conversation.user_requests(turns).orderBy("turn").collect()
    assert [(r.turn, r.history) for r in asked] == [(0, ""), (2, "User: hi\nAssistant: höllo\nthere"), (3, "User: hi\nAssistant: höllo\nthere")]


def test_hot_key_is_split_by_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        large = spark.range(60_000).repartition(6).select("id", F.when(F.col("id") < 40_000, 1).otherwise(F.col("id")).alias("k"))
        small = spark.range(5_000).select((F.col("id") % 2_000).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
        for how in ("inner", "left"):
            joined = skewed_join(large, small, "k", how)
            assert same(joined, large.join(small, "k", how))
            joined.collect()
            assert "skew=true" in plan_of(joined)
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes", "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{name}")


@pytest.mark.parametrize("n, group", [(0, 3), (1, 1), (17, 1), (17, 50), (399, 2), (400, 2), (1_000, 2)])
def test_first_of(spark, n, group):
    words = sorted({random.Random(i).choice(["a", "b", "bb", "é", "zz"]) * (i % 4 + 1) + str(i) for i in range(397)} | {"", "a", "aa"})
    df = spark.createDataFrame([(w,) for w in words], "token string").repartition(3)
    got = sorted(r.token for r in first_of(df, "token", n, group).collect())
    assert got == sorted(words, key=lambda w: w.encode())[:n]


def test_vocabulary_of_a_million_ties(spark):
    rows = spark.range(1_000_000).select(F.array(F.lpad(F.hex("id"), 8, "0")).alias("tokens"))
    learned = learn_vocabulary(rows, size=5_004)
    assert "TakeOrdered" not in plan_of(learned)
    got = learned.orderBy("id").collect()
    assert [r.token for r in got[4:]] == [f"{i:08X}" for i in range(5_000)]


# --- what was seen before


def hashes(spark, first, last):
    return spark.range(first, last).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))


def test_filter_denies_nothing_it_holds(spark):
    known = seen.SeenFilter.of(hashes(spark, 0, 20_000), "content_hash", 20_000 // seen.KEYS_PER_BUCKET + 1)
    assert known.possible(hashes(spark, 0, 20_000), "content_hash").count() == 20_000
    assert known.possible(hashes(spark, 50_000, 70_000), "content_hash").count() < 20_000 * 0.03


def test_filters_merge_and_are_kept(spark, tmp_path):
    a, b = (seen.SeenFilter.of(hashes(spark, i, i + 3_000), "content_hash", 4) for i in (0, 9_000))
    a.merged(b).save(str(tmp_path / "both"))
    both = seen.SeenFilter.load(spark, str(tmp_path / "both"))
    assert both.buckets == 4 and same(both.table, a.merged(b).table)
    for first in (0, 9_000):
        assert both.possible(hashes(spark, first, first + 3_000), "content_hash").count() == 3_000
    with pytest.raises(ValueError):
        a.merged(seen.SeenFilter.of(hashes(spark, 0, 1), "content_hash", 5))
    assert seen.SeenFilter.of(hashes(spark, 0, 0), "content_hash", 4).possible(hashes(spark, 0, 5), "content_hash").count() == 0


def test_increment_shuffles_little_of_what_is_known(spark):
    """Of 50,000 known hashes about as many leave their task as the increment repeats."""
    known = durable(hashes(spark, 0, 50_000), "known")
    new = hashes(spark, 49_000, 52_000)
    index = seen.SeenFilter.of(known, "content_hash", 16)
    hits = seen.known_hits(new, known, index)
    assert same(hits, hashes(spark, 49_000, 50_000))
    maybe = index.possible(new, "content_hash")
    wanted = seen.SeenFilter.of(maybe, "content_hash", seen._SENT_BUCKETS)
    assert wanted.possible(known, "content_hash", send=True).count() < 2_000


def test_increment_equals_plain_increment(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 120).alias("text"))
    known = durable(dedup.first_occurrences(docs.filter("doc_id < 60"), F.col("text"), "doc_id"), "known")
    index = seen.SeenFilter.of(known, "content_hash", 2)
    both, grown = seen.add_increment(known, docs, F.col("text"), "doc_id", seen=index)
    assert same(both, dedup.add_increment(known, docs, F.col("text"), "doc_id"))
    assert grown.possible(both, "content_hash").count() == 120


# --- summaries that merge


def test_sketch_ranks(spark):
    log = spark.range(60_000).select(
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 600).cast("int"))).alias("ts"),
        F.when(F.col("id") % 10 < 9, "/hot").otherwise("/g").alias("endpoint"),
        F.when(F.col("id") % 997 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000.0).alias("duration_s"),
    )
    minutes = sketches.latency_sketches(log)
    whole = sketches.merged_sketches(minutes, "endpoint")
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    stated = whole.select("endpoint", *[sketches.sketch_quantile(q).alias(n) for n, q in wanted.items()])
    errors = sketches.rank_errors(log, stated, wanted, ["endpoint"]).collect()
    assert len(errors) == 2 and all(r[f"{n}_error"] < 0.01 for r in errors for n in wanted)
    assert sum(r.n for r in errors) == log.filter("duration_s is not null").count() == whole.select(F.sum(sketches.sketch_count())).first()[0]


def test_users_of_any_span(spark):
    rows = [(T0 + dt.timedelta(hours=h), u) for h in range(0, 900, 5) for u in (h % 7, 32_768 * (h % 3), -h, None)] + [(None, 5)]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, user_id long")
    daily, rough = sketches.daily_users(log), sketches.daily_user_sketches(log)
    for span in ("day", "week", "month"):
        of = F.date_trunc(span, "date").cast("date")
        got = {r.span: r.active_users for r in sketches.users_of(daily, of).collect()}
        want = {r.s: r.n for r in log.filter("ts is not null").groupBy(F.date_trunc(span, "ts").cast("date").alias("s")).agg(F.countDistinct("user_id").alias("n")).collect()}
        assert got == want
        assert all(abs(r.active_users - want[r.span]) <= 0.05 * want[r.span] + 1 for r in sketches.users_of_sketches(rough, of).collect())


def test_distribution_distance(spark):
    rows = [("a", float(i % 10), i < 60) for i in range(100)] + [("b", 1.0, True), ("c", 1.0, True), ("c", 2.0, False), ("a", None, True), ("a", float("nan"), False)]
    df = spark.createDataFrame(rows, "k string, v double, second boolean")
    got = {r.k: (r.n_first, r.n_second, r.distance) for r in evaluation.distribution_distance(df, "v", F.col("second"), ["k"]).collect()}
    assert got == {"a": (40, 60, 0.0), "b": (0, 1, None), "c": (1, 1, 1.0)}
    assert evaluation.distribution_distance(df.filter("k = 'c'"), "v", F.col("second")).first().distance == 1.0


# --- versions and ingests


def test_only_changed_buckets_are_read(spark, tmp_path):
    old = spark.range(4_000).select(F.col("id").cast("string").alias("t"))
    new = old.filter("t <> '17'").unionByName(spark.createDataFrame([("new",), ("5",), ("5",)], "t string"))
    a, b = (versions.Buckets.write(d, F.col("t"), str(tmp_path / n)) for n, d in (("a", old), ("b", new)))
    changed = a.changed(b)
    assert 1 <= len(changed) <= 3
    assert same(a.diff(b), versions.version_diff(old, new, F.col("t"))) and tuple(a.diff(b).first()) == (3, 1, 3_999)
    scanned = spark.read.parquet(str(tmp_path / "b" / "hashes")).filter(F.col("bucket").isin(changed))
    scanned.collect()
    assert len({f.split("bucket=")[1][:2] for f in b.rows_in(changed).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) == len(changed)
    assert a.changed(a) == [] and tuple(a.diff(a).first()) == (0, 0, 4_000)


def test_versions_of_nothing(spark, tmp_path):
    none, one = spark.createDataFrame([], "t string"), spark.createDataFrame([("x",)], "t string")
    a, b = (versions.Buckets.write(d, F.col("t"), str(tmp_path / n)) for n, d in (("a", none), ("b", one)))
    assert tuple(a.diff(b).first()) == (1, 0, 0) and tuple(b.diff(a).first()) == (0, 1, 0) and tuple(a.diff(a).first()) == (0, 0, 0)


def test_ingest_counts_what_it_writes(spark, tmp_path):
    lines = ['{"body": "a"}', '{"body": "<b>a</b>", "parsed_content": "x"}', "", " ", "[1]", '{"body"', '{"body": "c"}', '{"body": "", "parsed_content": ""}', '{"body": ""}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "line_no int, value string").repartition(3)
    done = ingest(df, str(tmp_path / "out"), "line_no")
    assert done.counts == {"lines": 9, "blank": 2, "not_blank": 7, "rejected": 2, "records": 5, "duplicate": 2, "empty": 1, "training_rows": 2}
    assert done.records.count() == 5 and done.quarantine.count() == 2 and done.training.count() == 2
    assert {r.stage: r.rows for r in done.stages().collect()} == done.counts
    assert {r.reject_reason for r in done.quarantine.collect()} == {"not_an_object", "malformed_json"}
