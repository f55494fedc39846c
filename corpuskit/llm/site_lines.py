"""Boilerplate lines: lines that occur on many distinct sites.

Sites per line are counted with mergeable HyperLogLog sketches; lines whose estimate is near
the limit are counted exactly. A boilerplate line stays where it occurs first (least document
id) and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import SPACES, let, packed, unpacked
from corpuskit.session import durable

MIN_SITES = 10
SKETCH_BITS = 12
# Estimates within this share of the limit are replaced by exact counts: six standard errors
# of a sketch with 2^12 registers.
NEAR = 0.1


def _has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) > 0


def line_places(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One row per line with a word: document, row key, site, position and a 128-bit line hash."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = packed(
        docs,
        doc_id=F.col(f"`{doc_id}`"),
        row_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")),
        site=F.col(f"`{site}`").cast("string"),
        text=t,
    ).select("doc_id", "row_key", "site", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return lines.filter(_has_word(F.col("line"))).select(
        "doc_id", "row_key", "site", "at",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"),
    )


def boilerplate(places: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(h1, h2, first_doc)`` of lines on at least ``min_sites`` distinct sites.

    A line seen fewer times than ``min_sites`` cannot be on so many sites, so plain counts
    come first and sketches are kept for frequent lines only. A null site is no site.
    """
    key = ["h1", "h2"]
    frequent = (
        places.groupBy(*key)
        .agg(F.count("site").alias("n"), F.min("doc_id").alias("first_doc"))
        .filter(F.col("n") >= min_sites)
        .select(*key, "first_doc")
    )
    frequent = durable(frequent, "frequent-lines")
    seen = places.filter("site is not null").select(*key, "site").join(frequent.select(*key), key, "left_semi")
    sketched = seen.groupBy(*key).agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
    sites = F.hll_sketch_estimate("sketch")
    estimated = durable(sketched.select(*key, sites.alias("sites")), "line-sites")
    low, high = F.lit(min_sites * (1 - NEAR)), F.lit(min_sites * (1 + NEAR))
    sure = estimated.filter(F.col("sites") > high).select(*key)
    near = estimated.filter(F.col("sites").between(low, high)).select(*key)
    exact = (
        seen.join(near, key, "left_semi").distinct().groupBy(*key).agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_sites).select(*key)
    )
    return frequent.join(sure.unionByName(exact), key)


def without_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``row``, ``n_lines``, ``n_removed`` and ``kept_text``, one row for each row of ``docs``.

    Lines are compared byte for byte, lines without a word are never removed and a text
    without removals comes back unchanged (a null text as null). A boilerplate line repeated
    within its first document stays each time. Documents without an id come last and keep
    no line that others have. Repeated rows are treated alike; an empty table gives no rows.
    Only line hashes are shuffled to find boilerplate, one reduced row per line and task;
    texts move once, to meet the positions to remove. Runs jobs while it is called.
    """
    places = line_places(docs, doc_id, text, site)
    bad = durable(boilerplate(places, min_sites), "boilerplate")
    hits = (
        places.join(bad, ["h1", "h2"])
        .filter(F.coalesce(F.col("doc_id") > F.col("first_doc"), F.col("doc_id").isNull() & F.col("first_doc").isNotNull()))
        .select(F.coalesce("doc_id", F.lit(-1)).alias("hit_id"), F.col("row_key").alias("hit_key"), "at")
        .distinct()
        .groupBy("hit_id", "hit_key")
        .agg(F.collect_list("at").alias("gone"))
    )
    rows = packed(
        docs, hit_id=F.coalesce(F.col(f"`{doc_id}`"), F.lit(-1)), hit_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    ).join(hits, ["hit_id", "hit_key"], "left")
    t = F.col("row")[text]
    lines = F.split(F.coalesce(t, F.lit("")), "\n", -1)

    def cut(lines: Column) -> Column:
        # Positions are told apart by hash, so a text of many removed lines is gone through once.
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return rows.select(
        "row",
        F.size(F.filter(lines, _has_word)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), t).otherwise(let(lines, cut)).alias("kept_text"),
    )


def cleaned_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", length: str = "n_chars") -> DataFrame:
    """``docs`` with boilerplate cut; documents that consisted of nothing else are dropped."""
    done = without_boilerplate(docs, doc_id, text, site)
    done = done.filter((F.col("n_removed") == 0) | _has_word(F.col("kept_text")))
    new = {text: F.col("kept_text")}
    if length in docs.columns:
        changed = F.length("kept_text").cast(docs.schema[length].dataType)
        new[length] = F.when(F.col("n_removed") > 0, changed).otherwise(F.col("row")[length])
    return unpacked(done, **new)
