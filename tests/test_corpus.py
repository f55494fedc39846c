import json
import math

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.operators import dedup, quality, splits, versions
from corpuskit.operators.encoding import Vocabulary, pad, pretrained_encoder
from corpuskit.operators.skew import hot_keys, salted_join
from corpuskit.operators.vocabulary import learn_vocabulary
from corpuskit.plans import corpus


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_occurrence_wins(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, ""), (4, "")], "k int, t string")
    kept = dedup.first_occurrences(df, F.col("t"), "k")
    assert sorted(r.k for r in kept.collect()) == [1, 2, 4]
    both = dedup.first_occurrences(df, F.col("t"), "k", keep_empty=True)
    assert sorted(r.k for r in both.collect()) == [1, 2, 4, 5]


def test_duplicates_are_dropped_before_the_shuffle(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = plan_of(dedup.first_occurrences(docs, F.col("text"), "doc_id"))
    assert "row_number(), 1, Partial" in plan and plan.count("Exchange") == 1


def test_second_pass_adds_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "k int, t string")
    known = dedup.first_occurrences(df, F.col("t"), "k")
    assert dedup.add_increment(known, df, F.col("t"), "k").count() == 2
    more = spark.createDataFrame([(9, "c"), (8, "c"), (7, "a")], "k int, t string")
    assert sorted(r.k for r in dedup.add_increment(known, more, F.col("t"), "k").collect()) == [1, 2, 8]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 63, 117, 126, 309, 5000])
def test_exact_split_counts(spark, n):
    split = splits.exact_split(spark.range(n), "id")
    got = {r.split: r.rows for r in splits.split_counts(split).collect()}
    test = math.ceil(n * 0.1)
    validation = math.ceil((n - test) * (0.1 / (1 - 0.1)))
    want = {"test": test, "validation": validation, "train": n - test - validation}
    assert got == {k: v for k, v in want.items() if v}
    if n == 309:
        assert got == {"train": 247, "validation": 31, "test": 31}


def test_exact_split_is_a_partition_and_reproducible(spark):
    a = {r.id: r.split for r in splits.exact_split(spark.range(1000), "id").collect()}
    b = {r.id: r.split for r in splits.exact_split(spark.range(1000).repartition(5), "id").collect()}
    c = {r.id: r.split for r in splits.exact_split(spark.range(1000), "id", seed=7).collect()}
    assert a == b and len(a) == 1000 and a != c


def test_ratios_are_checked(spark):
    with pytest.raises(ValueError):
        splits.exact_split(spark.range(3), "id", ratios={"train": 0.5, "validation": 0.1, "test": 0.1})


def test_threshold_split_is_stable(spark):
    small = {r.id: r.split for r in splits.threshold_split(spark.range(100), "id").collect()}
    large = {r.id: r.split for r in splits.threshold_split(spark.range(10_000), "id").collect()}
    assert all(large[k] == v for k, v in small.items())
    share = sum(v == "train" for v in large.values()) / 10_000
    assert abs(share - 0.8) < 0.02
    assert "Exchange" not in plan_of(splits.threshold_split(spark.range(10), "id"))


@pytest.fixture(scope="module")
def vocabulary(spark):
    texts = spark.createDataFrame([(["b", "a", "a"],), (["c", "b", "a"],)], "tokens array<string>")
    return Vocabulary(learn_vocabulary(texts, size=6))


def test_vocabulary_order_and_size(spark):
    texts = spark.createDataFrame([(["b", "a", "a"],), (["c", "b", "a", "d"],)], "tokens array<string>")
    got = {r.id: r.token for r in learn_vocabulary(texts, size=7).collect()}
    assert got == {0: "<pad>", 1: "<unk>", 2: "<s>", 3: "</s>", 4: "a", 5: "b", 6: "c"}
    with pytest.raises(ValueError):
        learn_vocabulary(texts, size=4)


def encoded(spark, vocabulary, lists, length):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, tokens array<string>").repartition(3)
    ids = df.select("i", vocabulary.encode(F.col("tokens"), length).alias("ids"))
    return {r.i: (r.input_ids, r.attention_mask) for r in pad(ids, "ids", length).collect()}


def test_encode_pads_and_truncates(spark, vocabulary):
    got = encoded(spark, vocabulary, [["a", "zz", "b"], [], ["a"] * 9], 6)
    assert got[0] == ([2, 4, 1, 5, 3, 0], [1, 1, 1, 1, 1, 0])
    assert got[1] == ([2, 3, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0])
    assert got[2] == ([2, 4, 4, 4, 4, 3], [1] * 6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=12), min_size=1, max_size=20))
def test_decode_returns_known_tokens(spark, vocabulary, lists):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, tokens array<string>")
    ids = df.select("i", vocabulary.encode(F.col("tokens"), 64).alias("ids"))
    got = {r.i: r.t for r in ids.select("i", vocabulary.decode(F.col("ids")).alias("t")).collect()}
    assert got == {i: " ".join(t) for i, t in enumerate(lists)}


def test_pretrained_encoder(spark):
    tokenizers = pytest.importorskip("tokenizers")
    built = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[UNK]": 0, "hello": 1, "world": 2}, unk_token="[UNK]"))
    built.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    encode = pretrained_encoder(spark, built.to_str(), max_length=3)
    df = spark.createDataFrame([("<b>hello</b> world x world",), (None,)], "t string")
    assert [r.ids for r in df.select(encode(F.col("t")).alias("ids")).collect()] == [[1, 2, 0], []]


def sample(spark, rows, split=True):
    df = spark.createDataFrame(rows, "split string, input_ids array<int>, attention_mask array<int>")
    return df if split else df.drop("split")


ROWS = [
    ("train", [2, 5, 1, 0], [1, 1, 1, 0]), ("train", [2, 5, 1, 0], [1, 1, 1, 0]), ("train", [2, 6, 7, 3], [1, 1, 1, 1]),
    ("test", [2, 3, 0, 0], [1, 1, 0, 0]),
]


def test_report(spark):
    got = {r.split: r.asDict(recursive=True) for r in quality.quality_report(sample(spark, ROWS), 10).collect()}
    train, test = got["train"], got["test"]
    assert (train["count"], train["mean"], train["median"], train["std"], train["min"], train["max"]) == (3, 4, 4, 0, 4, 4)
    assert (train["unk_tokens"], train["total_tokens"]) == (2, 12) and train["pct_unk"] == pytest.approx(100 / 6)
    assert (train["unique_tokens"], train["coverage_pct"]) == (7, 70.0)
    assert train["duplicates"] == {"duplicate_rows": 2, "duplicate_variants": 1}
    assert test["std"] == 0 and test["duplicates"] == {"duplicate_rows": 0, "duplicate_variants": 0}


def test_report_variants(spark):
    masked = {r.split: r for r in quality.quality_report(sample(spark, ROWS), 10, mode="masked").collect()}
    assert masked["train"].median == 3 and masked["train"]["std"] == pytest.approx(0.57735, abs=1e-5)
    assert masked["train"].unique_tokens == 6
    whole = quality.quality_report(sample(spark, ROWS, split=False), 10, unk_id=None).collect()
    assert [(r.split, r.unk_tokens, r.pct_unk) for r in whole] == [("dataset", 0, 0.0)]
    assert quality.vocabulary_coverage(sample(spark, ROWS), 0).first().coverage_pct is None
    rough = quality.vocabulary_coverage(sample(spark, ROWS), 10, approximate=True).filter("split = 'train'").first()
    assert rough.unique_tokens == 7


def test_empty_corpus_stats(spark):
    none = spark.createDataFrame([], "ids array<int>")
    assert tuple(quality.corpus_stats(none).first()) == (0.0, 0, 0.0)


def test_build_then_validate(spark, tmp_path):
    lines = [json.dumps({"body": f"<p>text number {i}</p>", "parsed_content": "한글" if i else ""}) for i in range(309)]
    raw = spark.createDataFrame(list(enumerate(lines + lines[:50] + ["{bad", ""])), "line_no int, value string")
    built = corpus.build(raw, "line_no", corpus.BuildConfig(max_length=16), save_to=str(tmp_path / "d"))
    report = corpus.validate(spark, str(tmp_path / "d"), built.vocabulary.size, str(tmp_path / "r"))
    rows = {r.split: r for r in report.collect()}
    assert {s: r["count"] for s, r in rows.items()} == {"train": 247, "validation": 31, "test": 31}
    for r in rows.values():
        assert r.total_tokens == r["count"] * 16 and r.mean == r.median == r.min == r.max == 16 and r["std"] == 0
        assert r.coverage_pct == pytest.approx(r.unique_tokens / r.model_vocab_size * 100)
    saved = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert {s["split"] for s in saved} == {"train", "validation", "test"}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"), F.lit("train").alias("split"))
    a = versions.fingerprint(df, F.col("t")).collect()
    b = versions.fingerprint(df.repartition(7).orderBy(F.desc("t")), F.col("t")).collect()
    c = versions.fingerprint(df.withColumn("t", F.when(F.col("t") == "5", "x").otherwise(F.col("t"))), F.col("t")).collect()
    assert a == b and a != c


def test_version_folders(spark, tmp_path):
    df = spark.range(10).select("id", F.lit("train").alias("split"))
    prints = versions.fingerprint(df, F.col("id").cast("string"))
    path = tmp_path / f"version={versions.version_digest(prints)}"
    df.limit(3).write.parquet(str(path / "data-left-by-a-failed-attempt"))
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, str(path))
    with pytest.raises(RuntimeError):
        versions.write_version(df.limit(3), str(tmp_path), prints)
    assert versions.write_version(df, str(tmp_path), prints) == str(path)
    assert versions.read_version(spark, str(path)).count() == 10
    assert versions.write_version(df.limit(1), str(tmp_path), prints) == str(path)
    assert versions.read_version(spark, str(path)).count() == 10


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k")).repartition(6)
    got = [(r.k, r.n) for r in versions.number_rows(df, "k", "n", 100).orderBy("n").collect()]
    assert [n for _, n in got] == list(range(100, 1100)) and [k for k, _ in got] == sorted(k for k, _ in got)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how):
    large = spark.range(3000).select("id", F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 7).alias("k"))
    small = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d")], "k long, v string")
    plain = large.join(small, "k", how)
    salted = salted_join(large, small, "k", spread_by="id", how=how, rows_per_task=100)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.columns == plain.columns and "_salt" in plan_of(salted)
    assert "_salt" not in plan_of(salted_join(large, small, "k", spread_by="id", how=how))


def test_hot_keys_of_nothing(spark):
    assert hot_keys(spark.range(0), "id").isEmpty()


def test_every_hot_key_is_found(spark):
    df = spark.range(30_000).select((F.col("id") % 3_000).alias("k"))
    assert hot_keys(df, "k", 5).count() == 3_000 and hot_keys(df, "k", 10).isEmpty()


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a", "5"), (1, None, "x"), (None, "b", None), (7, "c", "6")], "k int, s string, n string")
    got = quality.check_expectations(
        df,
        [quality.not_null("s"), quality.in_range("k", 0, 5), quality.one_of("s", ["a", "b"]),
         quality.castable("n", "int"), quality.unique("k")],
    )
    assert {(r.column_name, r.check_name): r.failures for r in got.collect()} == {
        ("s", "not_null"): 1, ("k", "in_range"): 1, ("s", "one_of"): 1, ("n", "is_int"): 1, ("k", "unique"): 1,
    }


def test_specials_match_their_ids():
    assert fixed.SPECIAL_TOKENS[fixed.UNK_ID] == "<unk>" and fixed.SPECIAL_TOKENS[fixed.PAD_ID] == "<pad>"


def test_cleaning_is_not_repeated_in_a_build_that_keeps_duplicates(spark):
    from corpuskit.plans.corpus import BuildConfig, training_rows

    lines = spark.createDataFrame([(i, f'{{"body": "<b>{i}</b> one", "parsed_content": "x"}}') for i in range(3)], "line_no long, value string")
    config = BuildConfig(deduplicate=False, rules=(lambda t: F.regexp_replace(t, "one", "two"),))
    rows = training_rows(lines, "line_no", config)
    assert sorted(r.text for r in rows.collect()) == ["0 two\n\nx", "1 two\n\nx", "2 two\n\nx"]
    # Once for either field.
    assert rows._jdf.queryExecution().optimizedPlan().toString().count(", two, 1)") == 2


def test_pretrained_encoding_holds_few_texts_at_once(monkeypatch):
    from corpuskit.operators import encoding

    class Tokenizer:
        seen = []

        def encode_batch(self, texts):
            self.seen.append(sum(map(len, texts)))
            return [type("E", (), {"ids": [len(t)]}) for t in texts]

    texts = ["a" * (i % 50) * 1000 for i in range(500)]
    made = encoding.encode_some(Tokenizer(), pa.array(texts + [None]))
    assert made.to_pylist() == [[len(t)] for t in texts] + [[0]]
    assert max(Tokenizer.seen) <= encoding.ENCODE_BYTES + 50_000 and len(Tokenizer.seen) > 1
    assert encoding.encode_some(Tokenizer(), pa.array([], pa.string())).to_pylist() == []
