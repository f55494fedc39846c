"""The named queries against SQL, or against plain Python where SQL cannot say the same."""

import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from corpuskit.llm.queries import ORACLES, QUERIES, tokenizer_file
from tests.compare import difference, duck
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(sf):
    t = pq.read_table(f"{sf}/documents.parquet")
    return list(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist()))


def rows(spark, sf, name, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    assert difference(spark, duck(sf), sf, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op1_host_rules", "op7_site_lines", "op9_hilbert"])
def test_native(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_near_duplicates(spark, sf, docs):
    want = {d: (n, c, d == c) for d, (n, c) in brute.near_duplicates(docs).items()}
    assert rows(spark, sf, "op2_lsh_forest", "n_shingles", "component_id", "kept") == want


def test_token_ids(spark, sf, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want, start = {}, 0
    for d, t in sorted(docs):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows(spark, sf, "op3_re_pair", "start", "n_tokens", "ids_crc32") == want


def test_pieces(spark, sf, docs):
    import sentencepiece

    from corpuskit.llm import piece_viterbi

    content = Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    df = piece_viterbi.encode(spark.read.parquet(f"{sf}/documents.parquet"), content)
    got = {r.doc_id: r.ids for r in df.collect()}
    assert got == {d: model.encode(t or "") for d, t in docs}
    assert all(r.decodes for r in QUERIES["op4_piece_viterbi"](spark, sf).collect())


def test_leaks(spark, sf, docs):
    """Every document with a whole benchmark text is found; every find shares thirteen words."""
    t = pq.read_table(f"{sf}/benchmark.parquet")
    items = {i: " ".join(brute.words(x.lower())) for i, x in zip(t.column("item_id").to_pylist(), t.column("text").to_pylist())}
    got = {r.doc_id: set(r["items"]) for r in QUERIES["op5_template_leaks"](spark, sf).collect()}
    assert got.keys() == dict(docs).keys()

    def bare(text):
        return [w.strip("\"'.,;:!?()") for w in brute.words(text.lower())]

    # The least of each class of one template stands for it.
    assert got == brute.leaked(docs, list(zip(t.column("item_id").to_pylist(), t.column("text").to_pylist())))
    grams = {i: {tuple(bare(x)[k : k + 13]) for k in range(len(bare(x)) - 12)} for i, x in items.items()}
    for d, text in docs:
        flat = " ".join(brute.words(text.lower()))
        assert {i for i, x in items.items() if x in flat} <= got[d]
        own = bare(text)
        own = {tuple(own[k : k + 13]) for k in range(len(own) - 12)}
        assert all(grams[i] & own for i in got[d])
    assert any(got.values())


def test_token_counts(spark, sf, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    want = {}
    for d, t in docs:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want[d] = (len((t or "").encode()), n, n > 1024)
    assert rows(spark, sf, "op6_bpe_counts", "n_bytes", "n_tokens", "over_limit") == want


def test_secrets(spark, sf, docs):
    import re

    kinds = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        "access": (r"AKIA[A-Z0-9]+", 0, 16),
        "hex": (r"[0-9a-f]+", 0, 32),
    }
    want = {}
    for d, t in docs:
        spans, counts = [], []
        for k, (pattern, group, least) in enumerate(kinds.values()):
            found = [m for m in re.finditer(pattern, t or "", re.ASCII | (re.I if k == 0 else 0)) if len(m[group]) >= least]
            counts.append(len(found))
            spans += [(m.start(), k, m.end()) for m in found]
        names = list(kinds)
        want[d] = (*counts, brute.sha256(",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))))
    assert rows(spark, sf, "op8_secret_spans", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_shards(spark, sf, docs):
    got = QUERIES["op9_hilbert"](spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs
    }
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(v) for v in slots.values()]
    assert set(slots) == set(range(16)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)


def test_repeats(spark, sf, docs):
    want = {d: (n, k, brute.sha256(t)) for d, (n, k, t) in brute.repeats(docs).items()}
    assert rows(spark, sf, "op10_relative_parse", "n_words", "n_removed", "kept_sha256") == want
