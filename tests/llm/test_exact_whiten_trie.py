"""Exact duplicates, whitening and the prefix trie against plain Python, on small tables with everything in them."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import exact_dedup, prefix_trie, whitening
from corpuskit.llm.queries import QUERIES
from tests.llm import brute

LONG = "word " * 40_000


# --- exact duplicates

DOCS = [
    (1, "Same text"), (2, "same TEXT"), (3, "same text "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "É"), (9, LONG), (10, LONG.upper()),
    (2, "same text"), (None, "same text"), (None, "only nulls"), (None, "Only nulls"), (11, "İ"), (12, "i̇"), (13, "alone"), (13, "alone"),
]


def expected(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[brute.lower(t)].append(d)
    out = []
    for d, t in docs:
        ids = groups[brute.lower(t)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, brute.sha256(brute.lower(t))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "x", 1, "y", 2) for d, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, salt int, content string, keep_id int").repartition(5)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t) % 3, lambda t: F.lit(1)], ids=["sha256", "poor", "none"])
def test_groups(docs, digest):
    """The digest only deals out: texts that share one are told apart by their content."""
    got = exact_dedup.groups(docs, digest).collect()
    assert sorted(map(tuple, got), key=repr) == expected(DOCS)


def test_groups_of_hot_texts(spark):
    rows = spark.range(6_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("text"))
    local = exact_dedup.combined(rows.repartition(40).select("doc_id", F.sha2("text", 256).alias("digest"), F.col("text").alias("content")))
    assert {r.group_size for r in local.filter("content = 'hot'").collect()} == {2_000}
    got = exact_dedup.groups(rows)
    assert got.count() == 6_000 and got.filter("kept").count() == 51
    assert got.filter("keep_id = 5997 and group_size = 2000").count() == 2_000


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.groups(none).count() == 0 and exact_dedup.distinct_documents(none).count() == 0


def test_distinct_documents(docs):
    got = exact_dedup.distinct_documents(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, brute.lower(r.text)) for r in got.collect() if r.doc_id is not None) == sorted(
        {(k, t) for k, t in ((max((d for d, x in DOCS if brute.lower(x) == brute.lower(t) and d is not None), default=None), brute.lower(t)) for _, t in DOCS) if k is not None}
    )
    assert [r.text.lower() for r in got.filter("doc_id is null").collect()] == ["only nulls"]


def test_dedup_is_native(spark, sf):
    plan = QUERIES["op11_exact_dedup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


# --- whitening

VECTORS = [(i, [float(x) for x in np.random.default_rng(i % 40).normal(size=6)]) for i in range(120)]
DAMAGED = [(200, None), (201, [float("nan")] * 6), (202, [float("inf")] + [0.0] * 5), (203, [None] + [0.0] * 5), (204, [1.0]), (205, []), (206, [1e300] + [0.0] * 5)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, x string").repartition(4)


def brute_whitened(rows, components=32, counts=True):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    fit = x if counts else np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    centred = (fit - total / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    deviation = ((n * x - total) ** 2).sum(axis=1)
    return n, deviation, (x - total / n).astype(float) @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("counts", [True, False])
def test_whitening(spark, counts):
    got = whitening.whitened_rows(frame(spark, VECTORS + DAMAGED), 4, "counts" if counts else "one").collect()
    n, deviation, whitened, explained = brute_whitened(VECTORS, 4, counts)
    assert len(got) == 4 * len(VECTORS)
    made = np.zeros_like(whitened)
    for r in got:
        made[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[r.vec_id] and abs(r.explained - explained[r.component - 1]) < 1e-12
        assert r.identity_error < 1e-10
    signs = np.sign((made * whitened).sum(axis=0))
    assert np.allclose(made * signs, whitened, atol=1e-9)


def test_each_distinct_vector_once(spark):
    done = whitening.whiten(frame(spark, VECTORS))
    assert done.vectors.count() == 40 and done.vectors.agg(F.sum("weight")).first()[0] == 120


def test_nothing_to_whiten(spark):
    for rows in ([], DAMAGED[:4], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened_rows(frame(spark, rows)).count() == 0


def test_constant_dimension_has_no_component(spark):
    rows = [(i, [float(i), 5.0, -float(i)]) for i in range(10)]
    got = whitening.whitened_rows(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_deviation_is_exact_beyond_longs():
    x = np.array([[10**6, 10**6 + 64], [10**6 + 5, 10**6]])
    n, sums = 10**13, [10**19 + 3, 10**19 + 10**14 + 1]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening.squared(x, n, sums) == [w if w < 2**63 else None for w in want]
    assert whitening.squared(x, 2, [2 * 10**6 + 5, 2 * 10**6 + 64]) == [25 + 64**2, 25 + 64**2]


# --- the prefix trie


def brute_trie(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0))] for c, v in talks.items()}
    nodes = defaultdict(lambda: {"members": [], "ends": []})
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])]["members"].append(c)
        nodes[tuple(path)]["ends"].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    for key, node in nodes.items():
        gain = (len(node["members"]) - 1) * len(key[-1][1].encode()) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] += gain
            leaves[key[:d]] += not children[key]
    out = []
    for key, node in nodes.items():
        parent = min(nodes[key[:-1]]["members"]) if key else None
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        out.append((min(node["members"]), len(key), parent, len(node["members"]), children[key], leaves[key], saved[key], ends))
    return sorted(out, key=repr)


def talks(seed=1, n=400):
    rng = random.Random(seed)
    said = ["hello", "Hellö", "", None, "how are you", "fine"]
    rows = []
    for c in range(n):
        length = rng.choice([1, 2, 3, 5, 8, 12])
        if rng.random() < 0.4:
            rows += [(c, t, "user", "hot turn") for t in range(length)]
        else:
            rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(said) if t < 3 else f"{said[t % 6]} {rng.randrange(3)}") for t in range(length)]
    rows += [(1_000, t, "user", f"turn {t % 7}") for t in range(300)] + [(1_003, t, "user", f"turn {t % 7}") for t in range(250)]
    rows += [(2_001, 0, "user", "family without a first"), (2_002, None, "user", "no number"), (2_002, 0, "user", "zero"), (None, 0, "user", "nobody's")]
    return rows


def trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, k1 string, depth int")
    return sorted(map(tuple, prefix_trie.trie(df.repartition(5), **options).collect()), key=repr)


@pytest.mark.parametrize("shards, most", [(1, 1 << 17), (40, 2), (100_000, 2)])
def test_trie(spark, shards, most):
    """From one shard of everything to shards of single nodes, with a queue that spills all the time."""
    rows = talks()
    assert trie(spark, rows, shards=shards, most=most) == brute_trie(rows)


def test_small_tries(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(7, 0, None, None)], [(i, 0, "user", "same") for i in range(30)], [(5, t, "u", "x" * t) for t in range(20)]):
        assert trie(spark, rows) == brute_trie(rows)


def test_turns_with_one_number_have_an_order(spark):
    rows = [(5, 1, "user", "a"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, None, "user", "c")]
    assert trie(spark, rows) == trie(spark, rows[::-1]) and len(trie(spark, rows)) == 5


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    items = [(rng.randrange(20), rng.randrange(3), rng.randrange(3), i, -i) for i in range(2_000)]
    queue = prefix_trie.SpillingQueue(16)
    for item in items:
        queue.push(item)
    assert queue.spilled > 50
    for key in sorted({i[:3] for i in items}):
        assert sorted(queue.take(key)) == sorted(i for i in items if i[:3] == key)
        assert list(queue.take(key)) == []
    assert not queue


def test_ends_are_digested_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_CHUNK_BITS", 2)
    ids = [*range(0, 90, 3), -7, -8, -1]
    paths = spark.createDataFrame([(c, 1, 1, 9, -9) for c in ids], "conv_id long, length long, depth long, k1 long, k2 long").repartition(4)
    got = prefix_trie.ends(paths).collect()
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]


# --- shards as files, boilerplate in long texts


def test_shard_files_hold_every_row_once(spark, tmp_path):
    from corpuskit.llm import hilbert

    rows = [(i % 50, f"text {i % 120}", "a" if i % 3 else None, "en", -1) for i in range(600)]
    # Two texts with one checksum but different sizes, under one id.
    rows += [(7, "plumless", "a", "en", -1), (7, "buckeroo", "a", "en", -1), (None, None, None, None, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard int").repartition(4)
    hilbert.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select("doc_id", "text", "source", "lang").collect())) == sorted(
        map(repr, docs.select("doc_id", "text", "source", "lang").collect())
    )
    assert back.select("shard").distinct().count() == hilbert.SHARDS


@pytest.mark.parametrize("lines", [10, 40_000])
def test_boilerplate_in_long_texts(spark, lines):
    """Texts of nothing but boilerplate, and of every second line of it, in time that grows with their length."""
    from corpuskit.llm import site_lines

    body = "\n".join(f"line {i}" for i in range(lines))
    mixed = "\n".join(f"line {i}" if i % 2 else f"own {i}" for i in range(lines))
    rows = [(i, body if i < 11 else mixed, f"site{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(12)
    got = {r.row.doc_id: r for r in site_lines.without_boilerplate(docs).collect()}
    assert got[0].n_removed == 0 and got[0].kept_text == body
    assert all(got[i].n_removed == lines and got[i].kept_text == "" for i in range(1, 11))
    assert got[11].n_removed == lines // 2 and got[11].kept_text == "\n".join(f"own {i}" for i in range(0, lines, 2))


# --- templates that many questions share


def test_questions_of_one_template(spark):
    """Ten thousand questions and as many documents of one template: documents meet classes, not questions."""
    from corpuskit.llm import template_leaks

    def asked(i):
        return f"A farmer in the valley sells {i + 10} apples every morning and buys {i % 7 + 2} pears in the evening before walking home"

    def twice(i):
        return f"A farmer in the valley sells {i + 10} apples every morning and buys {i + 10} pears in the evening before walking home"

    items = spark.createDataFrame([(i, asked(i)) for i in range(10_000)] + [(20_000 + i, twice(i)) for i in range(50)], "item_id long, text string")
    members, windows = template_leaks.item_classes(items)
    # Where both numbers are the same by chance, the question is one of the second kind.
    by_class = {r.class_id: r["count"] for r in members.groupBy("class_id").count().collect()}
    assert sum(by_class.values()) == 10_050 and len(by_class) == 2 and windows.select("id").distinct().count() == 2
    docs = spark.range(10_000).repartition(8).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("Some words first. A farmer in the valley sells "), F.col("id") + 5, F.lit(" apples every morning and buys "),
                 F.when(F.col("id") % 2 == 0, F.col("id") + 5).otherwise(F.col("id") + 6), F.lit(" pears in the evening before walking home")).alias("text"),
    )
    got = template_leaks.leaks(docs, items)
    sizes = {tuple(r["items"]): (r["count"], r.n_items) for r in got.groupBy("items", "n_items").count().collect()}
    (one, two), (n_one, n_two) = sorted(by_class), (by_class[k] for k in sorted(by_class))
    assert sizes == {(one,): (5_000, n_one), (one, two): (5_000, n_one + n_two)}
    assert got.filter("not contaminated").count() == 0
