"""Quality rules with host verdicts.

Every text is measured and held against a few rules. A rule that a document fails is weak
evidence by itself; it counts if the document's host fails that rule as a habit. Per host and
rule, the rate of failing documents is shrunk towards the rate of all hosts by a beta prior
fitted to the hosts (method of moments), so a host with two documents is not condemned for
one. Two rules, the base rules, reject a document on their own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelkit.llm import flat
from panelkit.llm.common import durable, own, python_ready, quoted

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

# Rules as SQL on the measures; a document fails where the expression is true.
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
    "repeats": "100 * n_repeat_words > 20 * n_words",
}

HOST_LIMIT = 0.3  # shrunk rate of failing documents from which a host fails a rule
PRIOR_LIMITS = (1.0, 1000.0)  # least and greatest weight of the prior, in documents

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def measures(column) -> np.ndarray:
    """The measures of each text of a string column, one row per text."""
    data, offsets = flat.flatten(column)
    n = len(offsets) - 1
    starts, ends, docs = flat.spans(data, offsets, flat.SPACE)
    words = flat.hash_spans(data, starts, ends)
    out = np.zeros((n, len(MEASURES)), np.int64)
    out[:, 0] = np.bincount(docs, minlength=n)
    out[:, 1] = flat.per_text(flat.code_point_starts(data) & ~flat.SPACE[data], offsets)
    out[:, 2] = flat.per_text(_SYMBOL[data], offsets)

    first, last, line_docs = flat.spans(data, offsets, flat.NEWLINE)
    filled = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, line_docs = first[filled], last[filled], line_docs[filled]
    out[:, 5] = np.bincount(line_docs, minlength=n)
    lines = flat.hash_spans(data, first, last)
    grams, places = flat.windows(words, docs, 3)

    gram_at = np.searchsorted(docs[places], np.arange(n + 1))
    line_at = np.searchsorted(line_docs, np.arange(n + 1))
    repeated = np.zeros(len(words) + 2, bool)
    for i in range(n):
        own_lines = lines[line_at[i] : line_at[i + 1]]
        if len(own_lines) > 1:
            own_lines = np.sort(own_lines)
            out[i, 3] = np.count_nonzero(own_lines[1:] == own_lines[:-1])
        g = grams[gram_at[i] : gram_at[i + 1]]
        if len(g) > 1:
            order = np.argsort(g)
            sorted_g = g[order]
            same = sorted_g[1:] == sorted_g[:-1]
            if same.any():
                again = np.zeros(len(g), bool)
                again[1:] |= same
                again[:-1] |= same
                at = places[gram_at[i] + order[again]]
                for shift in range(3):
                    repeated[at + shift] = True
    out[:, 4] = np.bincount(docs[repeated[: len(docs)]], minlength=n)
    return out


def with_measures(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the measures as columns, and the names these got."""
    python_ready(df.sparkSession)
    taken, names = list(df.columns), {}
    for m in MEASURES:
        names[m] = own(m, taken)
        taken.append(names[m])
    schema = StructType(df.schema.fields + [StructField(names[m], LongType()) for m in MEASURES])
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for piece in flat.slices(batch, batch.schema.names[at]):
                found = measures(piece.column(at))
                columns = piece.columns + [pa.array(found[:, i]) for i in range(len(MEASURES))]
                yield pa.RecordBatch.from_arrays(columns, [*piece.schema.names, *names.values()])

    return df.mapInArrow(run, schema), names


def host_rates(measured: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, bad_<rule>...``: which rules each host fails.

    One aggregate per host, combined before the shuffle, so a host with a third of all rows
    is a few rows there. The prior is a single row, computed from the hosts.
    """
    fails = [F.sum(F.expr(f"CASE WHEN {sql} THEN 1 ELSE 0 END")).alias(f"n_{r}") for r, sql in RULES.items()]
    hosts = durable(measured.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *fails))
    stats = []
    for r in RULES:
        rate = F.col(f"n_{r}") / F.col("n")
        stats += [F.sum(f"n_{r}").alias(f"s_{r}"), F.avg(rate).alias(f"m_{r}"), F.var_pop(rate).alias(f"v_{r}")]
    overall = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("docs"), *stats).first()
    verdicts = []
    for r in RULES:
        alpha, beta = beta_prior(overall[f"m_{r}"] or 0.0, overall[f"v_{r}"] or 0.0)
        shrunk = (F.col(f"n_{r}") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
        verdicts.append((shrunk >= limit).alias(f"bad_{r}"))
    return hosts.select("host", *verdicts)


def beta_prior(mean: float, variance: float) -> tuple[float, float]:
    """Parameters of the beta distribution with this mean and variance over hosts."""
    low, high = PRIOR_LIMITS
    weight = mean * (1 - mean) / variance - 1 if variance > 0 else high
    weight = min(high, max(low, weight))
    return mean * weight, (1 - mean) * weight


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``host_failed``, ``kept``; a row per row.

    ``host_failed`` is true if the document fails a rule that its host fails; ``kept`` is
    false if it or ``base_failed`` is. A NULL text has no words and fails the base rules. Rows
    without a host share one host. An empty table gives an empty result, and repeated
    rows are judged alike. The measures are written once to the shared folder.
    """
    slim = df.select(quoted(doc_id).alias("doc_id"), quoted(host).alias("host"), quoted(text).alias("text"))
    measured, names = with_measures(slim)
    measured = durable(measured.select("doc_id", "host", *names.values()))
    return _with_verdict(measured, "host", MEASURES).drop("host", "n_lines")


def _with_verdict(measured: DataFrame, host: str, keep: list[str]) -> DataFrame:
    rates = host_rates(measured, host).withColumnRenamed("host", "verdict_host")
    joined = measured.join(rates, measured[host].eqNullSafe(rates["verdict_host"]), "left")
    bad = [F.expr(sql) & F.col(f"bad_{r}") for r, sql in RULES.items()]
    failed = F.coalesce(bad[0] | bad[1] | bad[2] | bad[3], F.lit(False))
    joined = joined.withColumn("base_failed", F.expr(BASE)).withColumn("host_failed", failed)
    joined = joined.withColumn("kept", ~(F.col("base_failed") | F.col("host_failed")))
    return joined.drop("verdict_host", *[f"bad_{r}" for r in RULES])


def keep_good(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``df`` that the rules keep, with its columns."""
    measured, names = with_measures(df.select(quoted(host).alias("host"), quoted(text).alias("text")))
    rates = host_rates(durable(measured.select("host", *names.values())), "host")
    flags = {r: own(f"bad_{r}", df.columns) for r in RULES}
    key = own("verdict_host", df.columns)
    rates = rates.select(F.col("host").alias(key), *[F.col(f"bad_{r}").alias(c) for r, c in flags.items()])
    again, names = with_measures(df, text)

    def on_measures(sql: str) -> str:
        return re.sub(r"\b(" + "|".join(MEASURES) + r")\b", lambda m: f"`{names[m[1]]}`", sql)

    joined = again.filter(f"NOT ({on_measures(BASE)})").join(rates, quoted(host).eqNullSafe(F.col(key)), "left")
    for r, sql in RULES.items():
        joined = joined.filter(f"NOT coalesce(({on_measures(sql)}) AND `{flags[r]}`, false)")
    return joined.select(*[quoted(c) for c in df.columns])
