"""The stages one after another against plain Python, and the repository without them."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from corpuskit.llm.queries import tokenizer_file
from tests.llm import brute


def test_pipeline(spark, sf):
    import sentencepiece

    t = pq.read_table(f"{sf}/documents.parquet")
    docs = list(zip(*[t.column(c).to_pylist() for c in ("doc_id", "text", "source")]))
    docs = [d for d in docs if not brute.base_failed(d[1])]
    cut = brute.without_boilerplate(docs)
    docs = [(d, cut[d], s) for d, _, s in docs if cut[d] is not None]
    near = brute.near_duplicates([d[:2] for d in docs])
    docs = [d for d in docs if near[d[0]][1] == d[0]]
    b = pq.read_table(f"{sf}/benchmark.parquet")
    found = brute.leaked([d[:2] for d in docs], list(zip(b.column("item_id").to_pylist(), b.column("text").to_pylist())))
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: (r.text, r.ids) for r in got} == {d: (x, model.encode(x or "")) for d, x, _ in docs if not found[d]}
    assert len(got) == sum(not found[d] for d, *_ in docs) and all(r.decodes for r in got)


@pytest.mark.parametrize("pipeline", [True, False])
def test_rest_stands_alone(tmp_path, sf, pipeline):
    """Without the two folders, with and without the pipeline file, the other queries are all there and run."""
    repo = Path(__file__).parents[2]
    gone = ["llm", "__pycache__", ".git", ".pytest_cache", ".hypothesis"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(repo, tmp_path / "repo", ignore=shutil.ignore_patterns(*gone))
    code = f"""
import __spark_entry__ as e
from corpuskit.catalogue import QUERIES
from corpuskit.session import local_session
assert e.queries().keys() == QUERIES.keys()
assert e.queries()["qa_pairs"](local_session("2"), {sf!r}).count()
"""
    subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")}
    )
