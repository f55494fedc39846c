"""Judging responses and comparing periods."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit import fixed
from corpuskit.operators import scan
from corpuskit.operators.vocabulary import token_counts
from corpuskit.session import durable


_SEARCHED = T.StructType([T.StructField("met", T.BooleanType()), T.StructField("error", T.StringType())])


@F.arrow_udf(_SEARCHED)
def _searched(patterns: pa.Array, responses: pa.Array) -> pa.Array:
    """Whether each pattern occurs in its response; a pattern that is none gives its error."""
    known: dict[str, re.Pattern | str] = {}
    out = []
    for pattern, response in zip(patterns.to_pylist(), responses.to_pylist()):
        if pattern is None or response is None:
            out.append({"met": None, "error": None})
            continue
        if pattern not in known:
            try:
                known[pattern] = re.compile(pattern, re.IGNORECASE)
            except (re.error, OverflowError, RecursionError) as error:
                known[pattern] = str(error)
        test = known[pattern]
        out.append({"met": None, "error": test} if isinstance(test, str) else {"met": test.search(response) is not None, "error": None})
    return pa.array(out, pa.struct([("met", pa.bool_()), ("error", pa.string())]))


def verdicts(cases: DataFrame, responses: DataFrame) -> DataFrame:
    """``test, status, reason, response, expected_pattern``: PASS, FAIL or ERROR per case.

    ``cases(test, expected_pattern)``, ``responses(test, status_code, response)``. A case
    without a response or with a malformed pattern is an error of its own and stops no other
    case. Patterns match anywhere, in any case. A response that was compared is shown by its
    first characters, and the pattern it did not match next to it.
    """
    ok = F.col("status_code") == 200
    joined = cases.join(responses, "test", "left")
    found = joined.withColumn("_s", _searched(F.when(ok, F.col("expected_pattern")), F.col("response")))
    error, met = F.col("_s.error"), F.coalesce("_s.met", F.lit(False))
    compared = ok & error.isNull()
    shown = F.concat(F.substring("response", 1, fixed.PREVIEW_CHARS), F.lit(fixed.PREVIEW_SUFFIX))
    return found.select(
        "test",
        F.when(F.col("status_code").isNull() | error.isNotNull(), "ERROR").when(~ok | ~met, "FAIL").otherwise("PASS").alias("status"),
        F.when(F.col("status_code").isNull(), "no response")
        .when(~ok, F.concat(F.lit(fixed.BAD_STATUS_REASON), F.col("status_code").cast("string")))
        .when(error.isNotNull(), error)
        .when(~met, fixed.NO_MATCH_REASON)
        .alias("reason"),
        F.when(compared, shown).alias("response"),
        F.when(compared & ~met, F.col("expected_pattern")).alias("expected_pattern"),
    )


def verdict_summary(judged: DataFrame) -> DataFrame:
    return judged.agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("total"))


def perplexity(train: DataFrame, validation: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Perplexity of the validation tokens under add-one unigram counts of the train tokens.

    Both sides are counted per token before they meet; the train counts are written down,
    as the totals come from them too. One extra type stands for all
    tokens not seen in training.
    """
    known = durable(token_counts(train, tokens).select("token", F.col("n").alias("seen")), "counts")
    size = known.agg(F.sum("seen").alias("total"), F.count("*").alias("types"))
    asked = token_counts(validation, tokens).join(known, "token", "left")
    all_counts = size.select((F.col("total") + F.col("types") + 1).alias("all")).scalar()
    return asked.agg(
        F.sum("n").alias("tokens"),
        F.sum(F.col("n") * F.log(F.coalesce("seen", F.lit(0)) + 1)).alias("log_seen"),
    ).select("tokens", F.exp(F.log(all_counts) - F.col("log_seen") / F.col("tokens")).alias("perplexity"))


def logprob_perplexity(scored: DataFrame, logprob: str, by: Sequence[str] = ()) -> DataFrame:
    """Perplexity from the log-probability of each token."""
    return scored.groupBy(*by).agg(F.exp(-F.avg(logprob)).alias("perplexity"))


def population_stability(
    df: DataFrame, value: str, is_second: Column, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Stability index of a value between two periods, over buckets with the given bounds.

    Empty buckets count as half a row, so the index is always defined.
    """
    bucket = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        bucket = F.when(F.col(value) <= bounds[i], i).otherwise(bucket)
    parts = [
        F.count_if((F.col("_bucket") == i) & (F.col("_second") == s)).alias(f"b{i}_{int(s)}")
        for i in range(len(bounds) + 1)
        for s in (False, True)
    ]
    counted = (
        df.select(*by, bucket.alias("_bucket"), is_second.alias("_second"))
        .groupBy(*by)
        .agg(*parts, F.count_if(~F.col("_second")).alias("n0"), F.count_if("_second").alias("n1"))
    )

    def share(i: int, s: int) -> Column:
        return F.try_divide(F.greatest(F.col(f"b{i}_{s}").cast("double"), F.lit(0.5)), F.col(f"n{s}"))

    terms = [(share(i, 0) - share(i, 1)) * F.log(F.try_divide(share(i, 0), share(i, 1))) for i in range(len(bounds) + 1)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return counted.select(*by, total.alias("psi"))


def distribution_distance(df: DataFrame, value: str, is_second: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n_first, n_second, distance)``: greatest gap between the cumulative distributions of two periods.

    Needs no buckets: rows are counted per distinct value, and the counts are summed up along the
    values by ranges, so neither a frequent value nor a large group burdens a task. NULL and NaN are
    left out; the distance is NULL where a period has no value. An action.
    """
    keys = list(by) or ["_all"]
    v = F.col(value).cast("double")
    held = df.withColumn("_all", F.lit(0)).filter(v.isNotNull() & ~F.isnan(v) & is_second.isNotNull())
    counted = held.groupBy(*keys, v.alias("_v")).agg(F.count_if(~is_second).alias("_n0"), F.count_if(is_second).alias("_n1"))
    ranged = scan.in_ranges(counted, keys, ["_v"])
    summed = scan.running(ranged, {f"_s{i}": ("sum", F.col(f"_n{i}")) for i in (0, 1)})
    totals = ranged.rows.groupBy(*keys).agg(F.sum("_n0").alias("n_first"), F.sum("_n1").alias("n_second"))
    met = summed.join(totals, keys)
    gap = F.abs(F.try_divide("_s0", "n_first") - F.try_divide("_s1", "n_second"))
    return met.groupBy(*keys).agg(F.max("n_first").alias("n_first"), F.max("n_second").alias("n_second"), F.max(gap).alias("distance")).select(
        *by, "n_first", "n_second", "distance"
    )


def dont_know_rate(responses: DataFrame, response: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of responses that admit having no answer."""
    hit = F.col(response).rlike(f"(?iu){fixed.DONT_KNOW}").cast("double")
    return responses.groupBy(*by).agg(F.count("*").alias("responses"), F.avg(hit).alias("dont_know_rate"))
