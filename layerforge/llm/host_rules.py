"""Host-level quality rules: failures are summed by host, shrunk with an empirical beta prior, and judged.

Every document is measured in place (one pass over the text).  The failures of each rule are counted
per host, partially in every task, so a host with a third of the documents moves as one row per task.
A rule's failure rates over the hosts are taken as draws of one beta distribution; its mean and its
strength come from the hosts themselves by the method of moments.  A host's rate is then the mean of its
posterior, (failures + strength * mean) / (documents + strength): a host with three documents says little,
one with a million speaks for itself.  A host whose shrunk rate of any rule lies above ``limit`` is
rejected, and with it its documents.  Only the rejected hosts are joined back.

Defined cases: a null text has no words and fails; documents without a host (null) have no host verdict
and do not take part in the prior; hosts are compared as given, the empty name is a host; repeated rows
count each; where hosts differ no more than chance would let them, all have the overall rate; an empty
table gives no rows; other columns are kept by ``keep_documents`` and ignored by ``judge_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.llm.common import free_names, stage

#: Fixed values of the base rules and of the host's further rules.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
SYMBOL_PERCENT, SHORT_WORD, LONG_WORD, DUP_LINE_PERCENT = 10, 3, 10, 30
SPACE, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
#: A host is rejected above this shrunk failure rate of a rule.
LIMIT = 0.5
#: Text bytes that a task measures at once (one longer text is measured alone).
SLICE = 4 << 20
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def rules(measure=F.col) -> dict[str, Column]:
    """Rule name -> condition under which a document fails it; ``measure`` gives a measure's column."""
    m = {name: measure(name) for name in MEASURES}
    return {
        "few_words": m["n_words"] < LEAST_WORDS,
        "repeats": 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"],
        "symbols": 100 * m["n_symbols"] > SYMBOL_PERCENT * m["n_words"],
        "word_length": (m["word_chars"] < SHORT_WORD * m["n_words"]) | (m["word_chars"] > LONG_WORD * m["n_words"]),
        "dup_lines": 100 * m["n_dup_lines"] > DUP_LINE_PERCENT * m["n_lines"],
    }


def _repeated(words: list[list[bytes]]) -> np.ndarray:
    """Per text: words in three-word windows that the text holds twice or more."""
    sizes = np.array([len(w) for w in words])
    if sizes.sum() < 3:
        return np.zeros(len(words), np.int64)
    code, known = pd.factorize(np.array([w for own in words for w in own], dtype=object))
    text = np.repeat(np.arange(len(words)), sizes)
    # A window as one number: its text and first word, then each further word, renumbered in between.
    window = text[:-2] * len(known) + code[:-2]
    for shift in (1, 2):
        window = pd.factorize(window)[0] * len(known) + code[shift:len(code) - 2 + shift]
    window = pd.factorize(window)[0]
    inside = text[:-2] == text[2:]
    again = inside & (np.bincount(window[inside], minlength=window.max() + 1)[window] > 1)
    covered = np.zeros(len(code), bool)
    for shift in (0, 1, 2):
        covered[shift:len(code) - 2 + shift] |= again
    return np.bincount(text[covered], minlength=len(words))


def measure_texts(texts: list[str]) -> dict[str, np.ndarray]:
    """The measures of whole texts, in their order."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at SPACE only
    lines = [[x for x in t.split("\n") if x.strip(SPACE)] for t in texts]
    return {
        "n_words": np.array([len(w) for w in words], np.int64),
        "word_chars": np.array([len(t) - sum(map(t.count, SPACE)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": _repeated(words).astype(np.int64),
    }


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def measured(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """``docs`` and one column per measure, named ``names`` in the order of MEASURES."""

    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            for start, end in _slices(texts):
                found = measure_texts(texts[start:end])
                yield pa.RecordBatch.from_arrays(b.slice(start, end - start).columns + [pa.array(found[m]) for m in MEASURES],
                                                 [*b.schema.names, *names])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField(n, T.LongType()) for n in names]))


def beta_priors(hosts: DataFrame, names: list[str]) -> dict[str, tuple[float, float | None]]:
    """Rule -> (mean, strength) of the beta prior over hosts (n_docs, one failure count per rule).

    The moment estimate for hosts of unequal size: with S the sum of n * (rate - mean)^2, the correlation
    inside hosts is (S / (mean * (1 - mean)) - (H - 1)) / (N - sum n^2 / N - (H - 1)), and the strength is
    1 / correlation - 1.  None: hosts do not differ beyond chance, every rate is the mean.
    """
    n = F.col("n_docs").cast("double")
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"), F.sum(n * n).alias("squares")]
    for r in names:
        f = F.col(r).cast("double")
        sums += [F.sum(f).alias(f"{r}_f"), F.sum(f * f / n).alias(f"{r}_s")]
    row = hosts.agg(*sums).head()
    priors: dict[str, tuple[float, float | None]] = {}
    for r in names:
        if not row["hosts"]:
            priors[r] = (0.0, None)
            continue
        mean = row[f"{r}_f"] / row["docs"]
        spread = row[f"{r}_s"] - mean * row[f"{r}_f"]
        room = row["docs"] - row["squares"] / row["docs"] - (row["hosts"] - 1)
        excess = spread / (mean * (1 - mean)) - (row["hosts"] - 1) if 0 < mean < 1 else 0.0
        strength = max(room / excess - 1, 0.0) if room > 0 and excess > 0 else None
        priors[r] = (mean, strength)
    return priors


def host_verdicts(rows: DataFrame, host: str, fails: dict[str, Column], limit: float = LIMIT) -> DataFrame:
    """host, n_docs, and per rule its failures and ``<rule>_rate`` (shrunk); rejected: a rate is above the limit."""
    named = rows.where(F.col(host).isNotNull())
    hosts = stage(named.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.coalesce(cond, F.lit(False)).cast("long")).alias(r) for r, cond in fails.items()]), "hosts")
    rates = {}
    for r, (mean, strength) in beta_priors(hosts, list(fails)).items():
        rates[r] = F.lit(mean) if strength is None else (
            (F.col(r) + F.lit(strength * mean)) / (F.col("n_docs") + F.lit(strength)))
    bad = F.lit(False)
    for rate in rates.values():
        bad = bad | (rate > F.lit(limit))
    return hosts.select("*", *[rate.alias(f"{r}_rate") for r, rate in rates.items()], bad.alias("rejected"))


def _judged(rows: DataFrame, host: str, names: list[str], verdict: str, limit: float) -> DataFrame:
    """``rows`` (staged) with the column ``verdict``: their host is rejected.

    Only rejected hosts are joined; the planner broadcasts them when their size at run time allows it, and
    otherwise cuts the partition of a large host.
    """
    of = dict(zip(MEASURES, names))
    bad = host_verdicts(rows, host, rules(lambda m: F.col(of[m])), limit).where("rejected").select(
        F.col("host").alias(f"{verdict}_host"), F.lit(True).alias(verdict))
    return (rows.join(bad, F.col(host) == F.col(f"{verdict}_host"), "left").drop(f"{verdict}_host")
            .withColumn(verdict, F.coalesce(verdict, F.lit(False))))


def judge_documents(docs: DataFrame, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """doc_id, the measures, base_failed (too few words or too many repeats), host_rejected, kept."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                        F.col("text").cast("string").alias("text"))
    rows = stage(measured(plain, "text", list(MEASURES)).drop("text"), "measures")
    base = rules()
    return (_judged(rows, "host", list(MEASURES), "host_rejected", limit)
            .withColumn("base_failed", base["few_words"] | base["repeats"])
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "host_rejected", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept")))


def keep_documents(docs: DataFrame, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base rules on a host that is not rejected."""
    names = free_names(docs, *MEASURES)
    (verdict,) = free_names(docs, "host_rejected")
    rows = stage(measured(docs, "text", names), "measured-docs")
    base = rules(lambda m: F.col(dict(zip(MEASURES, names))[m]))
    return _judged(rows, host, names, verdict, limit).where(
        ~(base["few_words"] | base["repeats"]) & ~F.col(verdict)).select(*docs.columns)


def oracle_sql(host: str = "source", limit: float = LIMIT) -> str:
    """The same rows by DuckDB SQL over ``documents``."""
    fails = {"few_words": f"n_words < {LEAST_WORDS}", "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
             "symbols": f"100 * n_symbols > {SYMBOL_PERCENT} * n_words",
             "word_length": f"word_chars < {SHORT_WORD} * n_words OR word_chars > {LONG_WORD} * n_words",
             "dup_lines": f"100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines"}
    rates = ", ".join(f"CASE WHEN {r}_x > 0 AND room > 0 THEN (f_{r} + greatest(room / {r}_x - 1, 0) * {r}_m) / "
                      f"(n + greatest(room / {r}_x - 1, 0)) ELSE {r}_m END AS {r}_rate" for r in fails)
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {host} AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
      FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d)),
tri AS (SELECT r, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM tri WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, word, b, c) > 1),
covered AS (SELECT r, count(DISTINCT i + s) AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS s) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, host, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN (SELECT r, count(*) AS n_words FROM w GROUP BY r) USING (r) LEFT JOIN covered USING (r) LEFT JOIN l USING (r)),
h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, {', '.join(f'CAST(count(*) FILTER ({c}) AS DOUBLE) AS f_{r}' for r, c in fails.items())}
      FROM m WHERE host IS NOT NULL GROUP BY host),
a AS (SELECT count(*) - 1 AS others, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room,
        {', '.join(f'sum(f_{r}) / sum(n) AS {r}_m, sum(f_{r} * f_{r} / n) - sum(f_{r}) / sum(n) * sum(f_{r}) AS {r}_s' for r in fails)} FROM h),
p AS (SELECT room, {', '.join(f'{r}_m, CASE WHEN {r}_m > 0 AND {r}_m < 1 THEN {r}_s / ({r}_m * (1 - {r}_m)) - others ELSE 0 END AS {r}_x' for r in fails)} FROM a),
v AS (SELECT host, {rates} FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept
FROM (SELECT m.*, ({fails['few_words']} OR {fails['repeats']}) AS base_failed,
        coalesce({' OR '.join(f'{r}_rate > {limit}' for r in fails)}, false) AS host_rejected
      FROM m LEFT JOIN v ON m.host = v.host)"""
