"""From columns to one feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = "features"


def encoder_stages(categorical: Sequence[str]) -> list:
    """One 0/1 slot per level, levels in alphabetical order, none left out.

    A level not seen in training, or null, gives all zeros: the indexer puts it
    in an extra last position, which is the one the encoder drops.
    """
    index = [f"{c}__index" for c in categorical]
    return [
        StringIndexer(
            inputCols=list(categorical),
            outputCols=index,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=index, outputCols=[f"{c}__levels" for c in categorical], dropLast=True
        ),
    ]


def feature_stages(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Encoded categories first, then the numbers unchanged.

    A missing number gives NaN; ``complete`` tells such rows.
    """
    inputs = [f"{c}__levels" for c in categorical] + list(numeric)
    return [
        *encoder_stages(categorical),
        VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"),
    ]


def complete(numeric: Sequence[str]) -> Column:
    """Whether a row has all these numbers."""
    known = F.lit(True)
    for c in numeric:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return known


def numeric_inputs(model: PipelineModel) -> list[str]:
    """The numbers that a fitted model reads."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c for c in assembler.getInputCols() if not c.endswith("__levels")]


def level_names(model: PipelineModel) -> dict[str, list[str]]:
    """Levels per categorical column, in slot order."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    return dict(zip(indexer.getInputCols(), [list(x) for x in indexer.labelsArray]))


def feature_names(model: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """Names of the vector's slots, such as ``department_General`` or ``age``."""
    encoded = [f"{c}_{v}" for c, levels in level_names(model).items() for v in levels]
    return encoded + list(numeric)


def one_hot_rows(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """The encoded columns as rows (key, feature, level): the slots that are 1.

    All others are 0, so nothing is lost and the result grows with the rows of ``df``
    only. A level that the encoder does not know has no row.
    """
    found = []
    for c, levels in level_names(model).items():
        known = F.array(*[F.lit(v) for v in levels])
        found.append(F.struct(F.lit(c).alias("feature"), F.get(known, F.col(f"{c}__index").cast("int")).alias("level")))
    hot = F.filter(F.array(*found), lambda s: s["level"].isNotNull())
    return model.transform(df).select(key, F.inline(hot))
