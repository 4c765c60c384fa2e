"""Host-level quality rules: what fails on a host decides about its other documents.

Base rules judge each document on its own text, in the row and without a shuffle.
Their failures are counted per host. A host with few documents says little by its own
rate, so rates are drawn towards the rate of all hosts by a beta prior that is fitted
to the hosts themselves. Documents of hosts whose shrunk rate is too high go as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import keep

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
MOST_STRENGTH = 1e6  # of the prior, in documents: where hosts don't differ beyond chance


def occurrences(text: Column, characters: str) -> Column:
    """How often single ASCII characters occur."""
    total = F.lit(0)
    for c in characters:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return total


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def with_metrics(df: DataFrame, text: str = "text", name: str = "quality__") -> DataFrame:
    """Add a struct column ``name`` with ``METRICS``; a null text has no words."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    staged = df.withColumns({f"{name}t": t, f"{name}w": words_of(t), f"{name}l": lines})
    w = F.col(f"{name}w")
    windows = F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    )
    hashed = staged.withColumn(f"{name}h", windows)
    h = F.col(f"{name}h")
    # only texts in which some window repeats are sorted by window
    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    ordered = hashed.withColumn(f"{name}s", F.when(repeats, placed))
    s = F.col(f"{name}s")
    same = F.filter(
        s,
        lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    )
    n_words = F.size(w).cast("long")
    tt = F.col(f"{name}t")
    repeat_words = F.coalesce(F.size(covered), F.lit(0)).cast("long")
    counted = ordered.withColumns({f"{name}r": repeat_words})
    r = F.col(f"{name}r")
    metrics = F.struct(
        n_words.alias("n_words"),
        (F.char_length(tt) - occurrences(tt, BLANKS)).cast("long").alias("word_chars"),
        occurrences(tt, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(f"{name}l") - F.size(F.array_distinct(f"{name}l"))).cast("long").alias("n_dup_lines"),
        r.alias("n_repeat_words"),
        ((n_words < 50) | (100 * r > 50 * n_words)).alias("base_failed"),
    )
    return counted.select(*[F.col(f"`{c}`") for c in df.columns], metrics.alias(name))


def host_verdicts(judged: DataFrame, host: str, failed: Column, max_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, rate, shrunk_rate, rejected), one row per host.

    The prior Beta(m * s, (1 - m) * s) has the mean rate m of all documents. Its strength s
    follows from the variance of the hosts' rates beyond that of chance. A host is rejected
    if its shrunk rate is above ``max_rate``. Rows without a host are one host (null).
    """
    hosts = keep(
        judged.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.count_if(failed).alias("n_failed")
        ),
        "hosts",
    )
    n, f = F.col("n_docs"), F.col("n_failed")
    # one row: what the prior needs of all hosts
    total, bad, squares, count = hosts.agg(
        F.sum(n), F.sum(f), F.sum(f.cast("double") * f / n), F.count(F.lit(1))
    ).first()
    mean = bad / total if total else 0.0
    chance = mean * (1 - mean)
    spread = (squares / total - mean * mean - chance * count / total) if total else 0.0
    strength = min(MOST_STRENGTH, max(1.0, chance / spread - 1)) if spread > 0 else MOST_STRENGTH
    shrunk = (f + F.lit(mean * strength)) / (n + F.lit(strength))
    return hosts.select(
        "host", "n_docs", "n_failed", (f / n).alias("rate"), shrunk.alias("shrunk_rate"),
        (shrunk > max_rate).alias("rejected"),
    )


def judge(
    df: DataFrame,
    text: str = "text",
    host: str = "source",
    max_rate: float = 0.5,
    name: str = "quality__",
    carried: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of ``df`` with a struct column ``name``: the metrics and ``kept``.

    Of the columns those in ``carried`` are kept (the host must be one; default: all).

    ``kept`` is false where the base rules fail (fewer than 50 words, or more than half of
    them in repeated windows of three words) or the host is rejected. Rows with a null host
    form one host, null and empty texts fail, repeated rows count as often as they occur, an
    empty table gives no rows. Columns of ``df`` keep their names and values.

    The rows are stored once with their metrics. Only the rejected hosts are joined to them,
    by broadcast if Spark knows from the stored size that they are few.
    """
    measured = with_metrics(df, text, name)
    if carried is not None:
        measured = measured.select(*[F.col(f"`{c}`") for c in carried], name)
    judged = keep(measured, "judged")
    verdicts = host_verdicts(judged, host, F.col(f"{name}.base_failed"), max_rate)
    rejected = keep(verdicts.where("rejected").select(F.col("host").alias(f"{name}host"), F.lit(True).alias(f"{name}out")))
    if rejected.isEmpty():
        out = judged.withColumn(f"{name}out", F.lit(False))
    else:
        out = judged.join(rejected, F.col(host).eqNullSafe(F.col(f"{name}host")), "left").drop(f"{name}host")
    kept = ~F.col(f"{name}.base_failed") & ~F.coalesce(F.col(f"{name}out"), F.lit(False))
    return out.withColumn(name, F.col(name).withField("kept", kept)).drop(f"{name}out")


def keep_good(df: DataFrame, text: str = "text", host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, unchanged."""
    return judge(df, text, host, max_rate).where("quality__.kept").drop("quality__")
