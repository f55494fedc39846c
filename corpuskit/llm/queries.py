"""The operators as named queries over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import (
    bpe_counts,
    exact_dedup,
    hilbert,
    host_rules,
    lsh_forest,
    piece_viterbi,
    prefix_trie,
    re_pair,
    relative_parse,
    secret_spans,
    site_lines,
    template_leaks,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file on the driver; tasks get its content."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _op(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

HOST_RULES_SQL = rf"""
    WITH w AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, {_WORDS} AS words FROM documents),
    k AS (SELECT row_number() OVER () AS r, * FROM w),
    windows AS (
      SELECT r, p, words[p:p + 4] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM k WHERE len(words) >= 5)),
    repeated AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c >= 2),
    covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM repeated) GROUP BY r),
    lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS dup
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM k) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
    f AS (
      SELECT k.doc_id, k.host, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
      FROM k LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
    b AS (SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
      100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS lines FROM f),
    rates AS (
      SELECT host, n, unnest(['short', 'repeats', 'symbols', 'lines']) AS rule, unnest([a, b, c, d]) AS failed
      FROM (SELECT host, count(*) AS n, count_if(short) AS a, count_if(repeats) AS b, count_if(symbols) AS c, count_if(lines) AS d
            FROM b GROUP BY host)),
    prior AS (
      SELECT rule, m, greatest(1, least(1000000, CASE WHEN spread - m * (1 - m) * inverse > 0
        THEN m * (1 - m) / (spread - m * (1 - m) * inverse) - 1 ELSE 1000000 END)) AS k
      FROM (SELECT rule, sum(failed) / sum(n) AS m, var_pop(failed / n) AS spread, avg(1 / n) AS inverse FROM rates GROUP BY rule)),
    bad AS (SELECT DISTINCT host FROM rates JOIN prior USING (rule) WHERE (failed + m * k) / (n + k) >= 0.5)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
      NOT (short OR repeats) AND NOT EXISTS (FROM bad WHERE bad.host IS NOT DISTINCT FROM b.host) AS kept,
      EXISTS (FROM bad WHERE bad.host IS NOT DISTINCT FROM b.host) AS host_rejected
    FROM b"""


@_op("op1_host_rules", HOST_RULES_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return host_rules.judged(_documents(spark, sf))


@_op("op6_bpe_counts")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    definition = Path(tokenizer_file("byte_bpe_50k.json")).read_text(encoding="utf-8")
    return bpe_counts.token_counts(_documents(spark, sf), definition)


SITE_LINES_SQL = r"""
    WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents),
    words AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS has FROM l),
    bad AS (SELECT line, min(doc_id) AS first_doc FROM words WHERE has GROUP BY line HAVING count(DISTINCT source) >= 10),
    kept AS (
      SELECT doc_id, count_if(has) AS n_lines, count(bad.line) AS n_removed,
        coalesce(string_agg(w.line, chr(10) ORDER BY p) FILTER (bad.line IS NULL), '') AS kept_text
      FROM words w LEFT JOIN bad ON w.line = bad.line AND has AND doc_id > first_doc GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
      sha256(CASE WHEN n_removed > 0 THEN kept_text ELSE d.text END) AS kept_sha256
    FROM documents d LEFT JOIN kept USING (doc_id)"""


@_op("op7_site_lines", SITE_LINES_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    done = site_lines.without_boilerplate(_documents(spark, sf))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_op("op8_secret_spans")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    ranks = Path(tokenizer_file("byte_bpe_50k.tiktoken")).read_bytes()
    return secret_spans.digest_columns(secret_spans.find_secrets(_documents(spark, sf), ranks))


@_op("op9_hilbert")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    placed = hilbert.shards(_documents(spark, sf))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@_op("op2_lsh_forest")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_forest.near_duplicates(_documents(spark, sf))


@_op("op10_relative_parse")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    done = relative_parse.without_repeats(_documents(spark, sf))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_op("op3_re_pair")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    definition = Path(tokenizer_file("word_bpe_49k.json")).read_text(encoding="utf-8")
    return re_pair.encoded_digests(_documents(spark, sf), definition)


@_op("op4_piece_viterbi")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    model = Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()
    encoded = piece_viterbi.encode(_documents(spark, sf).select("doc_id", "text"), model, decoded="decoded")
    same = F.coalesce(F.col("decoded") == F.replace("text", F.lit(piece_viterbi.MARK), F.lit(" ")), F.col("text").isNull())
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), same.alias("decodes")
    )


@_op("op5_template_leaks")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return template_leaks.leaks(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


EXACT_DEDUP_SQL = """
    WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    g AS (SELECT doc_id, sha256(t) AS text_sha256, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g"""


@_op("op11_exact_dedup", EXACT_DEDUP_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.groups(_documents(spark, sf))


@_op("op12_whitening")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened_rows(spark.read.parquet(f"{sf}/embeddings.parquet"))


# The checksum byte by byte and bit by bit, then every prefix as a list of its turns.
PREFIX_TRIE_SQL = """
    WITH t AS (
      SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
      FROM conversations WHERE conv_id IS NOT NULL),
    s AS (SELECT c, count(*) AS n, c - c % 5 AS base FROM t GROUP BY c),
    crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 9 AS h FROM s),
    m AS (SELECT crc.*, least(h, coalesce(b.n, 0)) AS shared FROM crc LEFT JOIN s b ON b.c = crc.base),
    turns AS (
      SELECT m.c, t.pos AS d, t.turn FROM m JOIN t ON t.c = m.base AND t.pos <= m.h
      UNION ALL SELECT m.c, shared + pos - h, t.turn FROM m JOIN t ON t.c = m.c AND t.pos > m.h),
    paths AS (SELECT m.c, coalesce(list(turn ORDER BY d) FILTER (d IS NOT NULL), []) AS path FROM m LEFT JOIN turns USING (c) GROUP BY m.c),
    rows AS (SELECT c, d, path[1:d] AS k, len(path) AS l FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)),
    nodes AS (
      SELECT k, d, min(c) AS c, count(*) AS n_convs, count(*) FILTER (l > d) = 0 AS leaf,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(k[d].text) END AS saved,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (l = d), '')) AS ends_sha256
      FROM rows GROUP BY k, d),
    under AS (
      SELECT r.k, r.d, count(*) FILTER (n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens
      FROM nodes n JOIN rows r ON r.c = n.c AND r.d <= n.d GROUP BY r.k, r.d),
    children AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2)
    SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n_convs, coalesce(children.n, 0) AS n_children,
      u.n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN under u ON u.k = n.k AND u.d = n.d
      LEFT JOIN children ON children.k = n.k AND children.d = n.d
      LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]"""


@_op("op13_prefix_trie", PREFIX_TRIE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf}/conversations.parquet"))
