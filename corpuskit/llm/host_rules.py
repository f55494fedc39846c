"""Quality rules per document, judged together with the host they come from.

Each rule's failures are counted per host, the host's failure rate is shrunk towards the rate
of all hosts by a beta prior fitted to the hosts' rates, and a host whose shrunk rate reaches
the rule's limit is rejected with all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import SPACES, WORD, let, packed, unpacked
from corpuskit.session import durable

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
HOST_LIMITS = {"short": 0.5, "repeats": 0.5, "symbols": 0.5, "lines": 0.5}
SYMBOL = r"[#*$%&|<>]"
SALTS = 16
FEW_HOSTS = 10_000

# The prior's strength in documents: at least one, and no more than this many.
STRONGEST = 1_000_000.0


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of ``width`` words that occur at least twice.

    Windows are compared by 64-bit hashes of their words' 64-bit hashes.
    """

    def windows(h: Column, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - width), make)

    def hashed(w: Column) -> Column:
        of_words = F.transform(w, lambda x: F.xxhash64(x))
        return let(of_words, lambda h: windows(h, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))

    def again(s: Column) -> Column:
        # Equal windows are neighbours once sorted; a place counts if it has an equal neighbour.
        def equal(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))

        same = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: equal(i, i + 1) | ((i > 0) & equal(i, F.greatest(i - 1, F.lit(0)))),
        )
        places = F.sort_array(F.transform(same, lambda i: F.get(s, i)["p"]))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to"))
        return F.aggregate(
            places,
            start,
            lambda acc, p: F.struct(
                (acc["n"] + p + width - F.greatest(p, acc["to"])).cast("bigint").alias("n"), (p + width).alias("to")
            ),
            lambda acc: acc["n"],
        )

    none = F.lit(0).cast("bigint")

    def counted(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(F.sort_array(placed), again))

    return F.when(F.size(words) < width, none).otherwise(let(hashed(words), counted))


def base_figures(text: Column) -> Column:
    """Struct of the figures of one text; a null text has no words."""

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("dup"),
        )

    def figures(words: Column, t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
            let(lines, of_lines).alias("lines"),
            repeated_words(words).alias("n_repeat_words"),
        )

    whole = F.coalesce(text, F.lit(""))
    return let(whole, lambda t: let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: figures(w, t)))


def document_figures(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """``doc_id``, ``host``, the figures and one boolean per rule for every row of ``docs``."""
    f = packed(docs, doc_id=F.col(f"`{doc_id}`"), host=F.col(f"`{host}`"), f=base_figures(F.col(f"`{text}`"))).select(
        "doc_id", "host", "f.n_words", "f.word_chars", "f.n_symbols", F.col("f.lines.dup").alias("n_dup_lines"),
        "f.n_repeat_words", F.col("f.lines.n").alias("n_lines"),
    )
    return f.select(
        "*",
        (F.col("n_words") < MIN_WORDS).alias("short"),
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")).alias("repeats"),
        (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")).alias("symbols"),
        (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")).alias("lines"),
    )


def host_verdicts(figures: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Per host and rule: documents, failures, shrunk rate, and whether the host is rejected.

    The prior of a rule is Beta(m k, (1 - m) k), m the pooled rate. Its strength k comes
    from the spread of the hosts' rates beyond what counting alone explains; hosts that
    differ no more than chance give a strong prior. One row per rule: four rows in all.
    Rows without a host form one host of their own.
    """
    limits = limits or HOST_LIMITS
    counted = figures.groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(rule)).alias(rule) for rule in limits]
    )
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed"), F.lit(v).alias("limit")) for r, v in limits.items()]
    )
    rates = counted.select("host", "n", F.inline(pairs)).withColumn("rate", F.col("failed") / F.col("n"))
    m = F.sum("failed") / F.sum("n")
    prior = rates.groupBy("rule").agg(
        m.alias("m"), F.var_pop("rate").alias("spread"), F.avg(1 / F.col("n")).alias("inverse")
    )
    variance = F.col("m") * (1 - F.col("m"))
    between = F.col("spread") - variance * F.col("inverse")
    strength = F.when(between > 0, variance / between - 1).otherwise(STRONGEST)
    prior = prior.select("rule", "m", F.greatest(F.lit(1.0), F.least(strength, F.lit(STRONGEST))).alias("k"))
    shrunk = (F.col("failed") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))
    return (
        rates.join(F.broadcast(prior), "rule")  # one row per rule
        .select("host", "rule", "n", "failed", shrunk.alias("shrunk_rate"), (shrunk >= F.col("limit")).alias("rejected"))
    )


def judged(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """Figures and verdicts, one row for each row of ``docs`` (repeated rows are kept).

    Null text: no words, so the base rules fail. Null host: a host of its own. Null id:
    judged like any other row. An empty table gives no rows. Texts of any length are read
    whole. The figures are written once and read twice, for hosts and for documents; the
    rejected hosts meet the documents spread over ``SALTS`` shares per host, because one
    host may hold a third of all rows. Runs a job while it is called.
    """
    figures = durable(document_figures(docs, doc_id, text, host), "figures")
    verdicts = host_verdicts(figures, limits).filter("rejected").select("host").distinct()
    # A null host is written as an empty struct field, so that it joins with itself.
    key = F.struct(F.coalesce("host", F.lit("")).alias("h"), F.isnull("host").alias("none"))
    bad = verdicts.select(key.alias("host_key"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = figures.withColumn("host_key", key).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    )
    marked = rows.join(bad.withColumn("host_rejected", F.lit(True)), ["host_key", "salt"], "left")
    failed = F.col("short") | F.col("repeats")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return marked.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~rejected).alias("kept"), rejected.alias("host_rejected"),
    )


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are.

    Whether a document passes by itself follows from its text, so texts are not shuffled by
    document. Rejected hosts are broadcast while there are at most ``FEW_HOSTS`` of them; more
    meet the rows spread over ``SALTS`` shares per host.
    """
    figures = durable(document_figures(docs, doc_id, text, host), "figures")
    bad = durable(host_verdicts(figures).filter("rejected").select(F.col("host").alias("bad_host")).distinct(), "hosts")
    own = let(
        base_figures(F.col(f"`{text}`")),
        lambda f: (f["n_words"] >= MIN_WORDS) & (100 * f["n_repeat_words"] <= MAX_REPEAT_PERCENT * f["n_words"]),
    )
    rows = packed(
        docs, host=F.col(f"`{host}`"), passed=own, salt=F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(SALTS)).cast("int")
    ).filter("passed")
    if bad.count() <= FEW_HOSTS:
        kept = rows.join(F.broadcast(bad), rows.host.eqNullSafe(bad.bad_host), "left_anti")
    else:
        bad = bad.withColumn("bad_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        kept = rows.join(bad, rows.host.eqNullSafe(bad.bad_host) & (rows.salt == bad.bad_salt), "left_anti")
    return unpacked(kept)
