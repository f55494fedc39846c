"""Queries over documents and pages: reading, cleaning, splitting, encoding, reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.catalogue import inputs
from corpuskit.catalogue.inputs import cleaned_sql, split_sql, threshold_sql, tokens_sql, unit_sql, table
from corpuskit.catalogue.registry import ORACLES, query
from corpuskit.functions import normalise
from corpuskit.functions import text as tx
from corpuskit.functions.tokens import passages, token_count, tokens
from corpuskit.operators import dedup, quality, seen, splits, versions
from corpuskit.operators.encoding import Vocabulary, pad, pretrained_encoder
from corpuskit.operators.vocabulary import learn_vocabulary, vocabulary_properties
from corpuskit.plans import corpus
from corpuskit.plans.ingest import ingest
from corpuskit.session import durable, new_path
from corpuskit.sources import lines as ln
from corpuskit.sources import store

V, L = fixed.VOCABULARY_SIZE, fixed.BUILD_MAX_LENGTH
CLEAN = cleaned_sql("text")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


# --- reading lines


@query("ingest_records", inputs.RAW_RECORDS_SQL)
def ingest_records(spark, sf):
    return ln.records(ln.parse_lines(inputs.raw_lines(spark, sf)))


@query(
    "ingest_quarantine",
    """SELECT doc_id * 10 + 1 AS line_no, '{"body": ' || doc_id AS value, 'malformed_json' AS reject_reason FROM documents
    UNION ALL SELECT doc_id * 10 + 3, '[' || doc_id || ']', 'not_an_object' FROM documents""",
)
def ingest_quarantine(spark, sf):
    return ln.quarantine(ln.parse_lines(inputs.raw_lines(spark, sf)))


@query("ingest_line_count", "SELECT 4 * count(*) AS line_count FROM documents")
def ingest_line_count(spark, sf):
    return ln.line_count(inputs.raw_lines(spark, sf))


@query("ingest_limit", f"SELECT * FROM ({inputs.RAW_RECORDS_SQL}) ORDER BY line_no LIMIT 100")
def ingest_limit(spark, sf):
    return ln.first_rows(ln.records(ln.parse_lines(inputs.raw_lines(spark, sf))), 100, "line_no")


@query("ingest_text_files", f"SELECT sha256(body) AS body_hash, parsed_content FROM ({inputs.RAW_RECORDS_SQL})")
def ingest_text_files(spark, sf):
    path = new_path(spark, "lines")
    inputs.raw_lines(spark, sf).select("value").write.text(path)
    read = ln.records(ln.parse_lines(ln.read_lines(spark, path)))
    return read.select(tx.content_hash(F.col("body")).alias("body_hash"), "parsed_content")


# --- cleaning


@query("clean_documents", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def clean_documents(spark, sf):
    return documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("text"))


@query("clean_markup", f"SELECT doc_id, {cleaned_sql("' ' || text || '& '")} AS text FROM documents")
def clean_markup(spark, sf):
    dirty = F.concat(F.lit("<p>"), F.col("text"), F.lit("&amp;</p>"))
    return documents(spark, sf).select("doc_id", tx.clean_text(dirty).alias("text"))


def _entities(x: str) -> str:
    # HTML lets these names end without the semicolon; pages cut off in mid-title show it.
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


_PAGE_VISIBLE = (
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'),"
    r" '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->|<[^>]+>', ' ', 'g')"
)


@query("page_visible_text", f"SELECT page_id, {cleaned_sql(_entities(_PAGE_VISIBLE))} AS text FROM pages")
def page_visible_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.visible_text(F.col("html")).alias("text"))


@query(
    "page_regex_text",
    f"""SELECT page_id, {cleaned_sql(_entities("regexp_replace(html, '<[^>]+>', ' ', 'g')"))} AS text FROM pages""",
)
def page_regex_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.preprocess_text(F.col("html"), "regex").alias("text"))


_TWICE = _entities(f"regexp_replace({_entities(_PAGE_VISIBLE)}, '<[^>]+>', ' ', 'g')")


@query("preprocess_pages", f"SELECT page_id, {cleaned_sql(_TWICE)} AS text FROM pages")
def preprocess_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.preprocess_text(F.col("html")).alias("text"))


@query("clean_with_rules", f"SELECT doc_id, replace(replace({CLEAN}, '.', ''), ',', ';') AS text FROM documents")
def clean_with_rules(spark, sf):
    rules = [lambda c: F.regexp_replace(c, r"\.", ""), lambda c: F.replace(c, F.lit(","), F.lit(";"))]
    cleaned = tx.clean_text(F.col("text"))
    return documents(spark, sf).select("doc_id", tx.apply_rules(cleaned, rules).alias("text"))


@query("clean_with_python_rules", f"SELECT doc_id, replace({CLEAN}, '.', '') AS text FROM documents")
def clean_with_python_rules(spark, sf):
    rules = [lambda t: t.replace(".", ""), lambda t: t[len(t) + 1], lambda t: t.strip()]
    cleaned = tx.clean_text(F.col("text"))
    return documents(spark, sf).select("doc_id", tx.apply_python_rules(cleaned, rules).alias("text"))


@query("content_hashes", f"SELECT doc_id, sha256({CLEAN}) AS content_hash FROM documents")
def content_hashes(spark, sf):
    return documents(spark, sf).select("doc_id", tx.content_hash(tx.clean_text(F.col("text"))).alias("content_hash"))


@query(
    "nested_record",
    f"""SELECT doc_id, text AS body_original, {CLEAN} AS body_processed,
      source AS parsed_original, trim(source) AS parsed_processed FROM documents""",
)
def nested_record(spark, sf):
    fields = {
        "body": (F.col("text"), tx.preprocess_text(F.col("text"))),
        "parsed_content": (F.col("source"), tx.preprocess_text(F.col("source"))),
    }
    nested = documents(spark, sf).select("doc_id", tx.nested_record(fields).alias("r"))
    return nested.select(
        "doc_id",
        F.col("r.body.original").alias("body_original"),
        F.col("r.body.processed").alias("body_processed"),
        F.col("r.parsed_content.original").alias("parsed_original"),
        F.col("r.parsed_content.processed").alias("parsed_processed"),
    )


@query(
    "mask_personal_data",
    f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{fixed.EMAIL}', '<email>', 'g'),
      '{fixed.PHONE}', '<phone>', 'g'), '{fixed.NUMBER_RUN}', '<number>', 'g') AS text FROM documents""",
)
def mask_personal_data(spark, sf):
    return documents(spark, sf).select("doc_id", tx.mask_personal_data(F.col("text")).alias("text"))


_STEP = fixed.PASSAGE_TOKENS - fixed.PASSAGE_OVERLAP


@query(
    "passages",
    f"""WITH w AS (SELECT doc_id, string_split({CLEAN}, ' ') AS words FROM documents),
    n AS (SELECT *, unnest(range(greatest(ceil((len(words) - {fixed.PASSAGE_OVERLAP}) / {_STEP}.0), 1)::BIGINT)) AS i FROM w)
    SELECT doc_id, i::INTEGER AS passage_no,
      array_to_string(words[i * {_STEP} + 1 : i * {_STEP} + {fixed.PASSAGE_TOKENS}], ' ') AS passage FROM n""",
)
def passages_of_documents(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("text"))
    return cleaned.select("doc_id", F.inline(passages(F.col("text"))))


# --- duplicates


@query(
    "dedup_exact",
    f"""SELECT doc_id, content_hash, lang, source FROM
      (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) AS r
       FROM (SELECT *, sha256({CLEAN}) AS content_hash FROM documents)) WHERE r = 1""",
)
def dedup_exact(spark, sf):
    cleaned = documents(spark, sf).withColumn("text", tx.clean_text(F.col("text")))
    return dedup.first_occurrences(cleaned, F.col("text"), "doc_id").select("doc_id", "content_hash", "lang", "source")


_TRAINING_SQL = f"""
    SELECT line_no, content_hash, body || chr(10) || chr(10) || parsed_content AS text FROM
      (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY line_no) AS r FROM
        (SELECT line_no, {cleaned_sql('body')} AS body, parsed_content, sha256({cleaned_sql('body')}) AS content_hash
         FROM ({inputs.RAW_RECORDS_SQL}))) WHERE r = 1"""


@query("training_text", _TRAINING_SQL)
def training_text(spark, sf):
    return corpus.training_rows(inputs.raw_lines(spark, sf), "line_no")


@query(
    "stage_counts",
    f"""WITH d AS (SELECT count(*) AS n, count(DISTINCT {CLEAN}) AS u FROM documents)
    SELECT 'lines' AS stage, 5 * n AS rows FROM d UNION ALL SELECT 'blank', n FROM d
    UNION ALL SELECT 'not_blank', 4 * n FROM d UNION ALL SELECT 'rejected', 2 * n FROM d
    UNION ALL SELECT 'records', 2 * n FROM d UNION ALL SELECT 'duplicate', 2 * n - u FROM d
    UNION ALL SELECT 'empty', 0 FROM d UNION ALL SELECT 'training_rows', u FROM d""",
)
def stage_counts(spark, sf):
    raw = inputs.raw_lines(spark, sf)
    body = tx.preprocess_text(F.col("record.body"))
    text = tx.training_text(body, tx.preprocess_text(F.col("record.parsed_content")))
    return quality.stage_counts(raw, ln.parse_lines(raw), body, text, F.col("line_no"))


@query("ingest_observed", ORACLES["stage_counts"])
def ingest_observed(spark, sf):
    return ingest(inputs.raw_lines(spark, sf), new_path(spark, "ingested"), "line_no").stages()


_INCREMENT_SQL = f"""
    WITH d AS (SELECT doc_id, lang, sha256({CLEAN}) AS content_hash FROM documents),
    known AS (SELECT min(doc_id) AS doc_id, content_hash FROM d WHERE lang <> 'en' GROUP BY 2),
    fresh AS (SELECT min(doc_id) AS doc_id, content_hash FROM d
              WHERE content_hash NOT IN (SELECT content_hash FROM known) GROUP BY 2)"""


@query("incremental_add", _INCREMENT_SQL + " SELECT * FROM known UNION ALL SELECT * FROM fresh")
def incremental_add(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", "lang", tx.clean_text(F.col("text")).alias("text"))
    known = durable(dedup.first_occurrences(cleaned.filter("lang <> 'en'"), F.col("text"), "doc_id"), "known")
    return dedup.add_increment(known, cleaned, F.col("text"), "doc_id").select("doc_id", "content_hash")


@query("incremental_add_filtered", _INCREMENT_SQL + " SELECT * FROM known UNION ALL SELECT * FROM fresh")
def incremental_add_filtered(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", "lang", tx.clean_text(F.col("text")).alias("text"))
    known = durable(dedup.first_occurrences(cleaned.filter("lang <> 'en'"), F.col("text"), "doc_id"), "known")
    path = new_path(spark, "seen")
    seen.SeenFilter.of(known, "content_hash", 64).save(path)
    both, _ = seen.add_increment(known, cleaned, F.col("text"), "doc_id", seen=seen.SeenFilter.load(spark, path))
    return both.select("doc_id", "content_hash")


# Letters with their accents apart, ligatures and wide figures: what NFKC puts together again.
_ACCENTS = {"é": "e\u0301", "è": "e\u0300", "ç": "c\u0327", "ü": "u\u0308", "ä": "a\u0308", "ö": "o\u0308", "ê": "e\u0302"}
_COMPATIBLE = {"fi": "\ufb01", "fl": "\ufb02", "1": "\uff11", "2": "\u00b2"}


@query("nfkc_text", "SELECT doc_id, sha256(nfc_normalize(text)) AS text_hash FROM documents")
def nfkc_text(spark, sf):
    text = F.col("text")
    for whole, parts in (_ACCENTS | _COMPATIBLE).items():
        text = F.replace(text, F.lit(whole), F.lit(parts))
    return documents(spark, sf).select("doc_id", F.sha2(normalise.nfkc(text), 256).alias("text_hash"))


# --- splits


@query("split_exact", split_sql("documents", "doc_id", "doc_id"))
def split_exact(spark, sf):
    return splits.exact_split(inputs.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("split_counts", f"SELECT split, count(*) AS rows FROM ({split_sql('documents', 'doc_id', 'doc_id')}) GROUP BY split")
def split_counts(spark, sf):
    return splits.split_counts(split_exact(spark, sf))


@query("split_threshold", f"SELECT doc_id, {threshold_sql('doc_id')} AS split FROM documents")
def split_threshold(spark, sf):
    return splits.threshold_split(inputs.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("sample_fraction", f"SELECT doc_id, lang FROM documents WHERE {unit_sql('doc_id')} < 0.25")
def sample_fraction(spark, sf):
    return splits.sample_fraction(inputs.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 0.25)


_LEAK_SQL = f"WITH s AS (SELECT DISTINCT sha256({CLEAN}) AS c, {threshold_sql('doc_id')} AS split FROM documents)"


@query(
    "split_leakage",
    _LEAK_SQL
    + """ SELECT a.x AS split_a, b.x AS split_b,
      (SELECT count(*) FROM s p JOIN s q ON p.c = q.c WHERE p.split = a.x AND q.split = b.x) AS shared_contents
    FROM (VALUES ('test'), ('train'), ('validation')) a(x) JOIN (VALUES ('test'), ('train'), ('validation')) b(x) ON a.x < b.x""",
)
def split_leakage(spark, sf):
    split = splits.threshold_split(documents(spark, sf), "doc_id")
    return splits.split_leakage(split, tx.content_hash(tx.clean_text(F.col("text"))))


# --- tokens, vocabulary, ids


@query("tokenize", f"SELECT doc_id, array_to_string({tokens_sql(CLEAN)}, ' ') AS tokens FROM documents")
def tokenize(spark, sf):
    return documents(spark, sf).select("doc_id", F.array_join(tokens(F.col("text")), " ").alias("tokens"))


@query("token_count", f"SELECT doc_id, len({tokens_sql(CLEAN)})::INTEGER AS tokens FROM documents")
def token_counts(spark, sf):
    return documents(spark, sf).select("doc_id", token_count(F.col("text")).alias("tokens"))


def _tokenised(spark, sf) -> DataFrame:
    split = splits.threshold_split(documents(spark, sf), "doc_id")
    return split.select("doc_id", "split", tokens(F.col("text")).alias("tokens"))


def _vocabulary(spark, sf) -> DataFrame:
    return learn_vocabulary(_tokenised(spark, sf).filter("split = 'train'"), size=V)


def _vocab_cte(texts: str, text: str) -> str:
    """CTEs ``toks`` and ``vocab`` from a relation ``texts`` with a train split."""
    return f"""
    toks AS (SELECT *, {tokens_sql(text)} AS t FROM {texts}),
    counted AS (SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM toks WHERE split = 'train') GROUP BY 1),
    vocab AS (SELECT (row_number() OVER (ORDER BY n DESC, token) + 3)::INTEGER AS id, token
              FROM (SELECT * FROM counted ORDER BY n DESC, token LIMIT {V - 4}))"""


def _encode_cte(key: str, length: int) -> str:
    """CTE ``enc(key, split, ids)`` from ``toks`` and ``vocab``."""
    return f"""
    flat AS (SELECT {key}, split, unnest(t[1:{length - 2}]) AS token, generate_subscripts(t[1:{length - 2}], 1) AS pos FROM toks),
    inner_ids AS (SELECT {key}, list(coalesce(id, 1) ORDER BY pos) AS ids FROM flat LEFT JOIN vocab USING (token) GROUP BY 1),
    enc AS (SELECT {key}, split, list_concat(list_concat([2], coalesce(ids, []::INTEGER[])), [3]) AS ids
            FROM toks LEFT JOIN inner_ids USING ({key}))"""


_DOC_SPLIT = f"s AS (SELECT doc_id, {CLEAN} AS text, {threshold_sql('doc_id')} AS split FROM documents)"
_DOC_VOCAB = f"WITH {_DOC_SPLIT}, {_vocab_cte('s', 'text')}"
_PADDED = f"list_concat(ids, list_resize([]::INTEGER[], {L} - len(ids), 0)) AS padded, len(ids) AS used"
_DOC_ENC = f"{_DOC_VOCAB}, {_encode_cte('doc_id', L)}"
_SPECIALS = " UNION ALL ".join(f"SELECT {i} AS id, '{t}' AS token" for i, t in enumerate(fixed.SPECIAL_TOKENS))


@query("vocabulary", f"{_DOC_VOCAB} SELECT id, token FROM vocab UNION ALL ({_SPECIALS})")
def vocabulary(spark, sf):
    return _vocabulary(spark, sf)


@query(
    "vocabulary_properties",
    f"{_DOC_VOCAB} SELECT count(*) + 4 AS vocab_size, 0 AS pad_id, 1 AS unk_id, 2 AS bos_id, 3 AS eos_id FROM vocab",
)
def vocabulary_facts(spark, sf):
    return vocabulary_properties(_vocabulary(spark, sf))


def _encoded(spark, sf, max_length: int = L) -> tuple[DataFrame, Vocabulary]:
    lookup = Vocabulary(durable(_vocabulary(spark, sf), "vocabulary"))
    ids = lookup.encode(F.col("tokens"), max_length).alias("ids")
    return _tokenised(spark, sf).select("doc_id", "split", ids), lookup


@query("encode", f"{_DOC_ENC} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM enc")
def encode(spark, sf):
    return _encoded(spark, sf)[0].select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "encode_padded",
    f"""{_DOC_ENC}, p AS (SELECT doc_id, {_PADDED} FROM enc)
    SELECT doc_id, array_to_string(padded, ' ') AS input_ids, used::INTEGER AS attended, len(padded)::INTEGER AS length FROM p""",
)
def encode_padded(spark, sf):
    padded = pad(_encoded(spark, sf)[0], "ids", L)
    return padded.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).alias("attended"),
        F.size("input_ids").alias("length"),
    )


@query(
    "decode",
    f"""{_DOC_VOCAB}, cut AS (SELECT doc_id, split, t[1:{L - 2}] AS t FROM toks),
    flat AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM cut),
    j AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM flat SEMI JOIN vocab USING (token) GROUP BY 1)
    SELECT doc_id, coalesce(j.text, '') AS text FROM documents LEFT JOIN j USING (doc_id)""",
)
def decode(spark, sf):
    encoded, lookup = _encoded(spark, sf)
    return encoded.select("doc_id", lookup.decode(F.col("ids")).alias("text"))


@query(
    "encode_pretrained",
    f"""{_DOC_VOCAB}, flat AS (SELECT doc_id, unnest(t[1:{L}]) AS token, generate_subscripts(t[1:{L}], 1) AS pos FROM toks),
    j AS (SELECT doc_id, string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids
      FROM flat LEFT JOIN vocab USING (token) GROUP BY 1)
    SELECT doc_id, coalesce(ids, '') AS ids FROM documents LEFT JOIN j USING (doc_id)""",
)
def encode_pretrained(spark, sf):
    # A ready-made tokenizer definition, here one holding the learned vocabulary.
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = Vocabulary(durable(_vocabulary(spark, sf), "vocabulary")).as_dict()
    made = Tokenizer(models.WordLevel(table, unk_token="<unk>"))
    made.pre_tokenizer = pre_tokenizers.Split(Regex(fixed.WORD_OR_PUNCTUATION), behavior="removed", invert=True)
    encode_text = pretrained_encoder(spark, made.to_str(), L)
    return documents(spark, sf).select(
        "doc_id", F.array_join(encode_text(F.col("text")).cast("array<string>"), " ").alias("ids")
    )


# --- quality


def _padded(spark, sf) -> DataFrame:
    return pad(_encoded(spark, sf)[0], "ids", L)


_REPORT_ENC = f"{_DOC_ENC}, e AS (SELECT split, {_PADDED} FROM enc)"
_LENGTHS = """count(*) AS count, round(avg({n}), 6) AS mean, median({n})::DOUBLE AS median,
      round(coalesce(stddev_samp({n}), 0), 6) AS std, min({n})::INTEGER AS min, max({n})::INTEGER AS max"""
_UNK = """sum(len(list_filter({ids}, lambda x: x = 1)))::BIGINT AS unk_tokens, sum(len({ids}))::BIGINT AS total_tokens,
      round(sum(len(list_filter({ids}, lambda x: x = 1))) * 100.0::DOUBLE / sum(len({ids})), 6) AS pct_unk"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("token_length_stats", f"{_REPORT_ENC} SELECT split, {_LENGTHS.format(n='used')} FROM e GROUP BY split")
def token_length_stats(spark, sf):
    return _rounded(quality.token_length_stats(_padded(spark, sf), mode="masked"), "mean", "std")


@query("unk_stats", f"{_REPORT_ENC} SELECT split, {_UNK.format(ids='padded')} FROM e GROUP BY split")
def unk_stats(spark, sf):
    return _rounded(quality.unknown_stats(_padded(spark, sf)), "pct_unk")


_COVER = """cover AS (SELECT split, count(DISTINCT id) AS unique_tokens FROM (SELECT split, unnest(padded) AS id FROM e) GROUP BY 1)"""
_DUP = """dup AS (SELECT split, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS duplicate_rows, count(*) FILTER (n > 1) AS duplicate_variants
      FROM (SELECT split, padded, count(*) AS n FROM e GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "vocab_coverage",
    f"""{_REPORT_ENC}, {_COVER} SELECT split, unique_tokens, {V}::BIGINT AS model_vocab_size,
      round(unique_tokens * 100.0::DOUBLE / {V}, 6) AS coverage_pct FROM cover""",
)
def vocab_coverage(spark, sf):
    return _rounded(quality.vocabulary_coverage(_padded(spark, sf), V), "coverage_pct")


@query("duplicate_stats", f"{_REPORT_ENC}, {_DUP} SELECT * FROM dup")
def duplicate_stats(spark, sf):
    return quality.duplicate_stats(_padded(spark, sf))


_REPORT_SELECT = f"""SELECT * FROM (SELECT split, {_LENGTHS.format(n='len(padded)')}, {_UNK.format(ids='padded')} FROM e GROUP BY split)
    JOIN (SELECT split, unique_tokens, {V}::BIGINT AS model_vocab_size,
      round(unique_tokens * 100.0::DOUBLE / {V}, 6) AS coverage_pct FROM cover) USING (split) JOIN dup USING (split)"""


def _flat_report(report: DataFrame) -> DataFrame:
    flat = report.select("*", "duplicates.*").drop("duplicates")
    return _rounded(flat, "mean", "std", "pct_unk", "coverage_pct")


@query("quality_report", f"{_REPORT_ENC}, {_COVER}, {_DUP} {_REPORT_SELECT}")
def quality_report(spark, sf):
    return _flat_report(quality.quality_report(durable(_padded(spark, sf), "encoded"), V))


# The report as it was written to its file.
@query("report_file", ORACLES["quality_report"])
def report_file(spark, sf):
    dataset, path = new_path(spark, "dataset"), new_path(spark, "report")
    store.save_splits(_padded(spark, sf), dataset)
    shape = corpus.validate(spark, dataset, V, report_path=path).schema
    return _flat_report(spark.read.schema(shape).json(path))


@query(
    "corpus_stats",
    f"""{_DOC_VOCAB}, {_encode_cte('doc_id', fixed.ENCODE_MAX_LENGTH)}
    SELECT round(avg(len(ids)), 6) AS avg_tokens, max(len(ids))::INTEGER AS max_tokens,
      round(sum(len(list_filter(ids, lambda x: x = 1))) * 100.0::DOUBLE / sum(len(ids)), 6) AS pct_unk FROM enc""",
)
def corpus_stats(spark, sf):
    return _rounded(quality.corpus_stats(_encoded(spark, sf, fixed.ENCODE_MAX_LENGTH)[0]), "avg_tokens", "pct_unk")


# --- versions


def _sums_sql() -> str:
    return " || ':' || ".join(
        ["count(*)::VARCHAR"]
        + [f"sum(('0x' || substr(d, {1 + 15 * i}, 15))::HUGEINT)::VARCHAR" for i in range(4)]
    )


@query(
    "dataset_fingerprint",
    f"""SELECT lang, count(*) AS rows, sha256({_sums_sql()}) AS digest
    FROM (SELECT lang, sha256({CLEAN}) AS d FROM documents) GROUP BY lang""",
)
def dataset_fingerprint(spark, sf):
    return versions.fingerprint(documents(spark, sf), tx.clean_text(F.col("text")), by="lang")


@query(
    "version_roundtrip",
    f"""SELECT lang, count(*) AS rows, sha256({_sums_sql()}) AS digest
    FROM (SELECT lang, sha256(doc_id || ' ' || text) AS d FROM documents) GROUP BY lang""",
)
def version_roundtrip(spark, sf):
    docs, base = documents(spark, sf).select("doc_id", "lang", "text"), new_path(spark, "versions")
    content = F.concat_ws(" ", F.col("doc_id").cast("string"), "text")
    path = versions.write_version(docs, base, versions.fingerprint(docs, content, by="lang"))
    return versions.fingerprint(versions.read_version(spark, path), content, by="lang")


# Second version: one language less, and every English text with a mark at the end.
def _second_version(docs: DataFrame) -> DataFrame:
    marked = F.when(F.col("lang") == "en", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return docs.filter("lang <> 'de'").withColumn("text", marked)


_SECOND_SQL = """SELECT * REPLACE (CASE WHEN lang = 'en' THEN text || '!' ELSE text END AS text)
    FROM documents WHERE lang <> 'de'"""


@query(
    "version_diff",
    f"""WITH o AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1),
    v AS (SELECT sha256(text) AS h, count(*) AS n FROM ({_SECOND_SQL}) GROUP BY 1),
    b AS (SELECT coalesce(o.n, 0) AS o, coalesce(v.n, 0) AS n FROM o FULL JOIN v USING (h))
    SELECT sum(greatest(n - o, 0))::BIGINT AS added, sum(greatest(o - n, 0))::BIGINT AS removed,
      sum(least(o, n))::BIGINT AS kept FROM b""",
)
def version_diff(spark, sf):
    docs = documents(spark, sf)
    return versions.version_diff(docs, _second_version(docs), F.col("text"))


@query("version_diff_buckets", ORACLES["version_diff"])
def version_diff_buckets(spark, sf):
    docs = documents(spark, sf)
    old, new = (versions.Buckets.write(d, F.col("text"), new_path(spark, "version")) for d in (docs, _second_version(docs)))
    return old.diff(new)


@query(
    "fingerprint_changes",
    """WITH o AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1)
    SELECT lang, n AS old_rows, CASE WHEN lang <> 'de' THEN n END AS new_rows,
      CASE lang WHEN 'de' THEN 'removed' WHEN 'en' THEN 'changed' ELSE 'same' END AS change FROM o""",
)
def fingerprint_changes(spark, sf):
    docs = documents(spark, sf)
    old, new = (versions.fingerprint(d, F.col("text"), by="lang") for d in (docs, _second_version(docs)))
    return versions.fingerprint_changes(old, new, by="lang")


# --- the whole build


_BUILD_ENC = f"""WITH texts AS ({_TRAINING_SQL}), s AS ({split_sql('texts', 'content_hash', 'line_no, text')}),
    {_vocab_cte('s', cleaned_sql('text'))}, {_encode_cte('line_no', L)}"""


@query(
    "corpus_build",
    f"""{_BUILD_ENC}, p AS (SELECT line_no, split, {_PADDED} FROM enc)
    SELECT line_no, split, array_to_string(padded, ' ') AS input_ids, used::INTEGER AS attended FROM p""",
)
def corpus_build(spark, sf):
    built = corpus.build(inputs.raw_lines(spark, sf), "line_no")
    return built.encoded.select(
        "line_no",
        "split",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).alias("attended"),
    )


# Another build: nothing dropped as a duplicate, digits cleaned away, other ratios, no start and end.
_OTHER_TRAINING = f"""SELECT line_no, {{0}} || CASE WHEN parsed_content = '' THEN '' ELSE chr(10) || chr(10) || {{1}} END AS text
    FROM ({inputs.RAW_RECORDS_SQL})""".format(
    f"regexp_replace({cleaned_sql('body')}, '[0-9]', '', 'g')", "regexp_replace(parsed_content, '[0-9]', '', 'g')"
)
_OTHER_SPLIT = """SELECT line_no, text,
      CASE WHEN place <= n_test THEN 'test'
           WHEN place <= n_test + ceil((n - n_test) * (0.2::DOUBLE / (1::DOUBLE - 0.2::DOUBLE))) THEN 'validation'
           ELSE 'train' END AS split
    FROM (SELECT *, ceil(n * 0.2::DOUBLE) AS n_test
          FROM (SELECT *, row_number() OVER (ORDER BY sha256(line_no::VARCHAR || ':42')) AS place, count(*) OVER () AS n FROM texts))"""


@query(
    "corpus_build_options",
    f"""WITH texts AS ({_OTHER_TRAINING}), s AS ({_OTHER_SPLIT}), {_vocab_cte('s', cleaned_sql('text'))},
    flat AS (SELECT line_no, unnest(t[1:32]) AS token, generate_subscripts(t[1:32], 1) AS pos FROM toks),
    ids AS (SELECT line_no, string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids, count(*)::INTEGER AS attended
      FROM flat LEFT JOIN vocab USING (token) GROUP BY 1)
    SELECT line_no, split, coalesce(ids, '') AS ids, coalesce(attended, 0) AS attended FROM toks LEFT JOIN ids USING (line_no)""",
)
def corpus_build_options(spark, sf):
    config = corpus.BuildConfig(
        deduplicate=False, rules=(lambda t: F.regexp_replace(t, "[0-9]", ""),), max_length=32, specials=False,
        ratios={"train": 0.6, "validation": 0.2, "test": 0.2},
    )
    built = corpus.build(inputs.raw_lines(spark, sf), "line_no", config).encoded
    used = F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m)
    ids = F.array_join(F.slice("input_ids", F.lit(1), used).cast("array<string>"), " ")
    return built.select("line_no", "split", ids.alias("ids"), used.alias("attended"))


@query("corpus_report", f"{_BUILD_ENC}, e AS (SELECT split, {_PADDED} FROM enc), {_COVER}, {_DUP} {_REPORT_SELECT}")
def corpus_report(spark, sf):
    path = new_path(spark, "dataset")
    corpus.build(inputs.raw_lines(spark, sf), "line_no", save_to=path)
    return _flat_report(corpus.validate(spark, path, V))


@query(
    "corpus_fingerprints",
    f"""{_BUILD_ENC}, p AS (SELECT split, sha256(array_to_string(list_concat(ids, list_resize([]::INTEGER[], {L} - len(ids), 0)), ' ')) AS d FROM enc
      UNION ALL SELECT 'vocabulary', sha256(id || ' ' || token) FROM (SELECT id, token FROM vocab UNION ALL ({_SPECIALS})))
    SELECT split, count(*) AS rows, sha256({_sums_sql()}) AS digest FROM p GROUP BY split""",
)
def corpus_fingerprints(spark, sf):
    return corpus.fingerprints(corpus.build(inputs.raw_lines(spark, sf), "line_no"))


@query("export_documents", "SELECT doc_id, lang, text FROM documents")
def export_documents(spark, sf):
    path = new_path(spark, "export")
    store.export(inputs.table(spark, sf, "documents").select("doc_id", "lang", "text"), path, fmt="parquet", by=["lang"])
    return spark.read.parquet(path).select("doc_id", "lang", "text")


# --- checks on any table


@query(
    "data_expectations",
    """WITH o AS (SELECT * FROM orders)
    SELECT 'o_orderkey' AS column_name, 'not_null' AS check_name, count(*) FILTER (o_orderkey IS NULL) AS failures FROM o
    UNION ALL SELECT 'o_totalprice', 'in_range', count(*) FILTER (NOT o_totalprice BETWEEN 1000 AND 100000) FROM o
    UNION ALL SELECT 'o_orderstatus', 'one_of', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM o
    UNION ALL SELECT 'o_orderstatus', 'is_int', count(*) FILTER (o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS INTEGER) IS NULL) FROM o
    UNION ALL SELECT 'o_orderkey', 'unique', count(o_orderkey) - count(DISTINCT o_orderkey) FROM o
    UNION ALL SELECT 'o_custkey', 'unique', count(o_custkey) - count(DISTINCT o_custkey) FROM o""",
)
def data_expectations(spark, sf):
    return quality.check_expectations(
        inputs.table(spark, sf, "orders"),
        [
            quality.not_null("o_orderkey"),
            quality.in_range("o_totalprice", 1000, 100000),
            quality.one_of("o_orderstatus", ["O", "F"]),
            quality.castable("o_orderstatus", "int"),
            quality.unique("o_orderkey"),
            quality.unique("o_custkey"),
        ],
    )


@query(
    "missing_references",
    """SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
)
def missing_references(spark, sf):
    parents = inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return quality.missing_references(inputs.table(spark, sf, "labels").select("doc_id", "quality"), parents, "doc_id")
