"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from pathlib import Path

import pytest

import corpus_pipeline
from corpuskit.llm import (
    bpe_counts, hilbert, host_rules, lsh_forest, piece_viterbi, re_pair, relative_parse, secret_spans, site_lines, template_leaks,
)
from corpuskit.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, node int, h1 string, words array<string>, ids int"
LONG = " ".join(f"word{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))


def row(d, text, source="a"):
    return (d, text, "en", source, len(text or ""), "clash", 1, "x", ["y"], 7)


ROWS = [
    row(1, PASSAGE), row(2, PASSAGE), row(2, PASSAGE), row(3, None), row(4, ""), row(5, " \n\t "), row(None, PASSAGE),
    row(None, None, None), row(6, LONG), row(7, LONG + " tail", None), row(8, "one two three"), row(9, "one two three"),
    row(10, "x " + PASSAGE + " y z"), row(11, PASSAGE + " " + PASSAGE),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE, "z"), (2, None, "z"), (None, PASSAGE, "z"), (3, "few words", "z")], "item_id long, text string, row string")


OPERATORS = {
    "op1": lambda d, b: host_rules.judged(d),
    "op2": lambda d, b: lsh_forest.near_duplicates(d),
    "op3": lambda d, b: re_pair.encoded_digests(d, Path(tokenizer_file("word_bpe_49k.json")).read_text(encoding="utf-8")),
    "op4": lambda d, b: piece_viterbi.encode(d, Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()),
    "op5": lambda d, b: template_leaks.leaks(d, b),
    "op6": lambda d, b: bpe_counts.token_counts(d, Path(tokenizer_file("byte_bpe_50k.json")).read_text(encoding="utf-8")),
    "op7": lambda d, b: site_lines.without_boilerplate(d),
    "op8": lambda d, b: secret_spans.find_secrets(d, Path(tokenizer_file("byte_bpe_50k.tiktoken")).read_bytes()),
    "op9": lambda d, b: hilbert.shards(d),
    "op10": lambda d, b: relative_parse.without_repeats(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, docs, none, benchmark):
    assert OPERATORS[name](docs, benchmark).count() == len(ROWS)
    assert OPERATORS[name](none, benchmark).count() == 0


def test_results(docs, benchmark):
    def of(df, *columns):
        return sorted({tuple(r[c] for c in columns) for r in df.collect()}, key=repr)

    judged = of(host_rules.judged(docs).filter("kept"), "doc_id")
    assert judged == [(1,), (10,), (2,), (6,), (7,), (None,)]
    near = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in lsh_forest.near_duplicates(docs).filter("doc_id is not null").collect()}
    assert near[1] == (36, 1, True) and near[2] == (36, 1, False) and near[10] == (39, 1, False)
    assert near[3] == (0, 3, True) and near[5] == (0, 5, True)
    assert near[7][1:] == (6, False) and near[8] == (1, 8, True) and near[9] == (1, 8, False)
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in relative_parse.without_repeats(docs).filter("doc_id is not null").collect()}
    assert cut[1] == (40, 0) and cut[2] == (40, 40) and cut[10] == (43, 40) and cut[11] == (80, 80) and cut[7] == (30_001, 30_000)
    assert cut[3] == (0, 0) and cut[9] == (3, 0)
    found = {r.doc_id: r["items"] for r in template_leaks.leaks(docs, benchmark).filter("contaminated").collect()}
    assert found == {d: [1] for d in (1, 2, 10, 11, None)}
    counts = {r.doc_id: (r.n_bytes, r.n_tokens) for r in OPERATORS["op6"](docs, benchmark).collect()}
    assert counts[3] == counts[4] == (0, 0) and counts[5][0] == 4


def test_null_id_with_others(spark):
    df = spark.createDataFrame([(None, PASSAGE), (None, LONG)], "doc_id long, text string")
    assert [(r.component_id, r.kept) for r in lsh_forest.near_duplicates(df).collect()] == [(None, True)] * 2


def test_near_copies_without_ids(spark):
    """Near copies without ids are linked, and connect texts that have ids."""
    words = [f"w{i}" for i in range(60)]
    texts = [(1, words), (None, words[:50]), (2, words[:42]), (None, ["other", *words[::-1]]), (None, words[::-1])]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in texts], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in lsh_forest.near_duplicates(df).collect()), key=repr)
    assert got == [(1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (None, None, True)]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_columns(spark, docs, none, sf, stage):
    run = corpus_pipeline.STAGES[stage][1]
    out = run(spark, docs, sf)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    kept = {r.doc_id for r in out.collect()}
    assert {6, 7} & kept and 10 in kept | {10 if stage == 2 else None}
    assert run(spark, none, sf).count() == 0


def test_boilerplate_on_ten_sites(spark):
    rows = [row(d, f"own line {d}\nall rights reserved\n", f"s{d % 12}") for d in range(40)] + [row(99, "all rights reserved", "s1")]
    rows += [row(200 + d, f"mine {d}\nnine sites only", f"s{d % 9}") for d in range(30)]
    got = {r.doc_id: r.text for r in site_lines.cleaned_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == "own line 0\nall rights reserved\n" and got[1] == "own line 1\n" and 99 not in got
    assert got[201] == "mine 1\nnine sites only"


def test_worker_gives_up_what_only_earlier_stages_used(spark, monkeypatch):
    import sys

    from corpuskit.llm import common

    class Context:
        stage = 1

        @classmethod
        def get(cls):
            return cls()

        def stageId(self):
            return self.stage

    monkeypatch.setattr(common, "TaskContext", Context)
    monkeypatch.delitem(sys.modules, "_corpuskit_worker", raising=False)
    first = common.worker_state("a", list)
    assert common.worker_state("b", list) is not first and common.worker_state("a", list) is first
    Context.stage = 2
    assert common.worker_state("a", list) is first
    common.worker_state("c", list)
    held = vars(sys.modules["_corpuskit_worker"])
    assert held["a"] is first and "b" not in held and "c" in held
    monkeypatch.delitem(sys.modules, "_corpuskit_worker")
