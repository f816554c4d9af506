"""Quality rules by document and by host.

Each document is measured and judged by rules of its own. The failures of every rule are then counted by host, and a
host's rate is shrunk towards that of all hosts with a beta prior fitted to them (by moments: the spread of the hosts'
rates beyond what chance gives). A host whose shrunk rate is above worst for any rule is rejected with all its documents.

Words are runs of characters other than blank and U+0009 to U+000D. Null is an empty text with no words, which fails.
Documents without a host (null) are one host. Every row is judged for itself, repeated ones too; an empty table gives an
empty result. New columns take the place of columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_column, kept_table, strings, text_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated(words: list[bytes]) -> int:
    """Words in windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
        keys ^= keys >> np.uint64(29)
    _, where, often = np.unique(keys, return_inverse=True, return_counts=True)
    likely = np.flatnonzero(often[where] > 1)
    if not len(likely):
        return 0
    seen: dict[tuple[bytes, ...], list[int]] = {}
    for i in likely.tolist():
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            edges[places] += 1
            edges[np.array(places) + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measured(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    chars = len(text) - sum(data.count(b) for b in BLANKS)
    symbols = sum(data.count(s) for s in SYMBOLS)
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), _repeated(words)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns MEASURES."""

    def run(batch: pa.Array) -> pa.Array:
        found = np.array([measured(t) for t in strings(batch)], np.int64).reshape(-1, len(MEASURES))
        return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(MEASURES))], names=list(MEASURES))

    kind = ", ".join(f"{m} long" for m in MEASURES)
    found = df.withColumn("__measures", arrow_column(run, f"struct<{kind.replace(' long', ':long')}>")(text_of(df[text])))
    return found.withColumns({m: F.col("__measures")[m] for m in MEASURES}).drop("__measures")


def rules() -> dict[str, Column]:
    """Failures, by rule. The first two are the base rules, which reject a document by themselves."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": words < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (chars < 3 * words) | (chars > 10 * words),
    }


def host_rates(measures: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, and failures and shrunk rate of each rule (rate_<rule>)."""
    counts = measures.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *(F.sum(failed.cast("long")).alias(name) for name, failed in rules().items())
    )
    counts = kept_table(counts, "hosts")
    total = counts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        *(F.sum(name).alias(name) for name in rules()),
        *(F.sum(F.col(name) * F.col(name) / F.col("n")).alias(f"{name}_2") for name in rules()),
    ).first()
    rates = {}
    for name in rules():
        alpha, beta = _prior(total["hosts"], total["n"] or 0, total[name] or 0, total[f"{name}_2"] or 0.0)
        rates[f"rate_{name}"] = (F.col(name) + alpha) / (F.col("n") + (alpha + beta))
    return counts.withColumns(rates)


def _prior(hosts: int, n: int, failed: int, squares: float) -> tuple[float, float]:
    """Of a beta distribution with the hosts' mean rate and their spread beyond chance."""
    mean = failed / n if n else 0.0
    if not 0 < mean < 1:
        return mean, 1 - mean
    chance = mean * (1 - mean) * hosts / n
    spread = max(squares / n - mean * mean - chance, mean * (1 - mean) / 1e6)
    strength = max(mean * (1 - mean) / spread - 1, 1.0)
    return mean * strength, (1 - mean) * strength


def judge(df: DataFrame, text: str = "text", host: str = "source", worst: float = 0.5) -> DataFrame:
    """Adds the measures, base_failed, host_rejected and kept.

    The texts are measured twice, once to count by host and once to judge, so that no text is ever shuffled for it.
    Hosts that are rejected are joined back; a hot host's rows are dealt anew by the adaptive skew join.
    """
    found = host_rates(measure(df.select(host, text), text), host)
    bad = F.greatest(*(F.col(f"rate_{name}") for name in rules())) > worst
    rejected = kept_table(found.filter(bad).select(F.col("host").alias("__host"), F.lit(True).alias("__host_rejected")), "rejected")
    base = rules()
    judged = measure(df, text).withColumn("base_failed", base["few_words"] | base["repeats"])
    judged = judged.join(rejected, judged[host].eqNullSafe(rejected["__host"]), "left").drop("__host")
    judged = judged.withColumn("host_rejected", F.coalesce("__host_rejected", F.lit(False))).drop("__host_rejected")
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
