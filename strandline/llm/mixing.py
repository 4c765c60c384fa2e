"""Soft-membership mixing: document rates that bring domains to target token totals.

A classifier fitted to labelled rows gives every document a posterior over the domains, so a
document counts for each domain with part of its tokens. Rates are then fitted by projected
gradient steps on least squares: the expected tokens of the domains, at these rates, against
their targets, each gap relative to the domain's present tokens, with a small pull towards rate 1 so that the solution is unique and documents
that need no change get none. Rates stay nonnegative (and below ``max_rate``).

A step needs one sum per domain over all documents and changes a document's rate by its own
posterior only. So a rate follows from the posterior and the list of the steps so far: each
round is one aggregate over stored narrow rows, without shuffle or state.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.session import keep

MOST_LABELLED = 20_000  # labelled rows that the classifier is fitted to
FEATURES = 1 << 13
WORD_GAP = r"[\x20\x09-\x0D.,]+"  # between the words that are counted
REGULARISATION = 1e-5
PULL = 1e-5
ROUNDS = 500
ENOUGH = 1e-4  # of a domain's target: tokens that a round still moves when the rounds end


def fit_domains(
    df: DataFrame, labels: DataFrame, domain: Column, text: str, doc_id: str, most: int = MOST_LABELLED
) -> tuple[PipelineModel | None, list[str]]:
    """A classifier of texts and the domains in the order of its posteriors.

    At most ``most`` labelled rows are used, those with the smallest hash of their id. With fewer
    than two domains there is nothing to fit, and the model is None.
    """
    known = labels.select(F.col(doc_id).alias("id__"), domain.alias("domain")).where(
        "id__ IS NOT NULL AND domain IS NOT NULL"
    )
    chosen = known.orderBy(F.xxhash64("id__"), "id__", "domain").limit(most)
    train = keep(
        df.select(F.col(doc_id).alias("id__"), text_of(text).alias("text__")).join(F.broadcast(chosen), "id__"),
        "labelled",
    )
    found = [r[0] for r in train.select("domain").distinct().orderBy("domain").collect()]
    if len(found) < 2:
        return None, found
    number = F.element_at(F.create_map(*[x for i, d in enumerate(found) for x in (F.lit(d), F.lit(float(i)))]), F.col("domain"))
    stages = [
        RegexTokenizer(inputCol="text__", outputCol="words__", pattern=WORD_GAP, toLowercase=True),
        HashingTF(inputCol="words__", outputCol="tf__", numFeatures=FEATURES, binary=True),
        IDF(inputCol="tf__", outputCol="idf__"),
        Normalizer(inputCol="idf__", outputCol="unit__"),
        LogisticRegression(
            featuresCol="unit__", labelCol="label__", probabilityCol="posterior__", rawPredictionCol="raw__",
            predictionCol="predicted__", family="multinomial", regParam=REGULARISATION, maxIter=60, standardization=False,
        ),
    ]
    return Pipeline(stages=stages).fit(train.withColumn("label__", number)), found


def text_of(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def posteriors(df: DataFrame, model: PipelineModel | None, domains: list[str], text: str) -> DataFrame:
    """``df`` with tokens__ (words) and posterior__ (one number per domain)."""
    named = df.withColumn("text__", text_of(text))
    if model is None:
        trimmed = F.btrim("text__", F.lit(" \t\n\x0b\f\r.,"))
        count = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WORD_GAP)))
        each = F.array(*[F.lit(1.0)] * max(1, len(domains)))
        scored = named.withColumns({"tokens__": count.cast("long"), "posterior__": each})
    else:
        scored = model.transform(named)
        scored = scored.withColumns(
            {"tokens__": F.size("words__").cast("long"), "posterior__": vector_to_array("posterior__")}
        )
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], "tokens__", "posterior__")


def rates_of(
    posterior: np.ndarray, steps: list[tuple[np.ndarray, float]], max_rate: float | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rates after these steps (relative gap of the domain totals at the extrapolated rates, momentum),
    the rates extrapolated from them, and the last step: from the extrapolated rates, and of the rates."""
    rate = np.ones(len(posterior))
    ahead, step, change = rate, np.zeros(len(posterior)), np.zeros(len(posterior))
    for gap, momentum in steps:
        moved = ahead - (posterior @ gap + PULL * (ahead - 1)) / (1 + PULL)
        moved = np.clip(moved, 0, max_rate)
        step, change = moved - ahead, moved - rate
        ahead = moved + momentum * change
        rate = moved
    return rate, ahead, step, change


def sums_of(posterior: np.ndarray, tokens: np.ndarray, steps: list, max_rate: float | None) -> np.ndarray:
    """Per domain the tokens at the extrapolated rates and those that the last step moved, then how
    far the step agrees with the change of the rates."""
    _, ahead, step, change = rates_of(posterior, steps, max_rate)
    return np.concatenate([(tokens * ahead) @ posterior, (tokens * np.abs(step)) @ posterior, [tokens @ (step * change)]])


def descend(
    sums: Callable[[list], np.ndarray], multiples: np.ndarray, rounds: int = ROUNDS
) -> list[tuple[np.ndarray, float]]:
    """The steps that lead to the rates; ``sums`` gives ``sums_of`` over all documents.

    A domain's gap counts relative to its own present tokens. As posteriors add up to one, a whole
    step is then short enough for any sizes of the domains. Momentum starts anew when it leads uphill.
    """
    count = len(multiples)
    steps: list[tuple[np.ndarray, float]] = []
    now = sums(steps)
    present = now[:count]
    if not present.sum():
        return steps
    scale = np.where(present > 0, present, 1.0)
    small = ENOUGH * np.where(multiples > 0, multiples, 1.0) * scale
    t = 1.0
    for _ in range(rounds):
        gap = (now[:count] - present * multiples) / scale
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        steps.append((gap, (t - 1) / following))
        t = following
        now = sums(steps)
        moved = now[count : 2 * count]
        if (moved <= small).all():
            return steps
        if now[-1] < 0:
            t = 1.0
    warnings.warn(
        f"rates not settled after {rounds} rounds; a round still moves these parts of the domains: "
        f"{(moved / scale).tolist()}",
        RuntimeWarning,
        stacklevel=2,
    )
    return steps


def reachable(multiples: list[float], max_rate: float | None) -> np.ndarray:
    """The targets, at most what a domain has when all its documents are at ``max_rate``.

    A gap that never closes would hold up the rates of all documents that have part in the domain.
    """
    return np.clip(np.array(multiples, float), None, max_rate)


def fit_rates(
    scored: DataFrame, multiples: np.ndarray, max_rate: float | None, rounds: int = ROUNDS
) -> list[tuple[np.ndarray, float]]:
    """The steps that lead to the rates; each round sums tokens * rate * posterior per domain."""
    count = len(multiples)
    names = [f"d{i}" for i in range(2 * count + 1)]

    def over_all(steps: list) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(names))
            for batch in batches:
                posterior = batch.column("posterior__").flatten().to_numpy().reshape(-1, count)
                total += sums_of(posterior, batch.column("tokens__").to_numpy().astype(float), steps, max_rate)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names)

        rows = scored.select("posterior__", "tokens__").mapInArrow(sums, ", ".join(f"{c} double" for c in names))
        # one row per task
        row = rows.agg(*[F.sum(c) for c in names]).first()
        return np.array([x or 0.0 for x in row])

    return descend(over_all, multiples, rounds)


def mix(
    df: DataFrame,
    labels: DataFrame,
    domain: Column,
    multiples: Mapping[str, float],
    max_rate: float | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    most_labelled: int = MOST_LABELLED,
    carried: list[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` with a struct ``mix__``: tokens, posteriors (domain to number), rate, copies.

    ``domain`` is the label of a row of ``labels`` (doc_id and other columns); rows whose domain or
    id is null are not used, and a document with several labels counts once for each. ``multiples``
    are the targets: per domain the expected tokens wanted, as a multiple of the present ones;
    a domain without an entry should stay as it is. More than ``max_rate`` cannot be reached and
    counts as ``max_rate``. ``copies`` is the rate rounded up or down by a
    hash of the row, so that totals hold on average, and a rate of 1 or more never gives none.

    Without labelled rows all documents form one domain and keep rate 1. Null and empty texts have
    no tokens and get a rate like others. Equal rows get equal rates. ``carried`` names the columns
    to keep (default: all, with their names and values). An empty table gives no rows.
    """
    model, domains = fit_domains(df, labels, domain, text, doc_id, most_labelled)
    scored = posteriors(df, model, domains, text)
    names = carried if carried is not None else df.columns
    scored = keep(
        scored.select(*[F.col(f"`{c}`") for c in names], "tokens__", "posterior__",
                      F.xxhash64(F.col(doc_id), F.col(text).cast("string")).alias("draw__")),
        "posteriors",
    )
    domains = domains or ["all"]
    wanted = reachable([multiples.get(d, 1.0) for d in domains], max_rate)
    steps = fit_rates(scored, wanted, max_rate)
    count = len(domains)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posterior = batch.column("posterior__").flatten().to_numpy().reshape(-1, count)
            rate = rates_of(posterior, steps, max_rate)[0]
            yield batch.append_column("rate__", pa.array(rate))

    schema = T.StructType([*scored.schema.fields, T.StructField("rate__", T.DoubleType())])
    out = scored.mapInArrow(final, schema)
    part = F.pmod("draw__", F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(F.col("rate__") + part).cast("long")
    named = F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), "posterior__")
    result = F.struct(
        F.col("tokens__").alias("tokens"), named.alias("posteriors"), F.col("rate__").alias("rate"),
        copies.alias("copies"),
    )
    return out.select(*[F.col(f"`{c}`") for c in names], result.alias("mix__"))


def mixed(df: DataFrame, *args, **settings) -> DataFrame:
    """The rows of ``df``, each as often as ``mix`` gives it copies, otherwise unchanged."""
    chosen = mix(df, *args, **settings).where("mix__.copies > 0")
    repeated = chosen.withColumn("copy__", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix__.copies"))))
    return repeated.drop("mix__", "copy__")


def label_domain() -> Column:
    """Domain of a row of the labels table: toxic, else good or plain by its quality."""
    return (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")
    )
