"""The readmission model: train, evaluate, and score patients from Silver."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from strandline.models.scoring import high_risk, report, score, score_all
from strandline.models.training import feature_importance, train_forest, train_logistic
from strandline.operators.aggregates import top_k
from strandline.operators.evaluate import roc_curve
from strandline.operators.split import stratified_split
from strandline.schemas import PATIENTS
from strandline.session import build_session, keep, sized_for
from strandline.sources.runs import current_path
from strandline.sources.zones import read_curated, write_json, write_parquet

# The target and the inputs of the model.
TARGET = "readmitted_30d"
NUMERIC = ["age", "length_of_stay"]
CATEGORICAL = ["gender", "department", "admission_type", "diagnosis"]


def readmission_run(
    spark: SparkSession,
    silver_zone: str,
    out: str,
    trees: int = 300,
    depth: int = 8,
    threshold: float = 0.5,
) -> DataFrame:
    """Fit both models on 75% of the patients and evaluate them on the others.

    Writes below ``out``: ``predictions`` (test rows with both scores), ``report``
    (JSON), ``top_features``, ``roc_logistic``, ``roc_forest``, and ``high_risk``
    (all patients whose forest score reaches the threshold). Patients whose age or stay
    is missing take no part in the fits; they are listed without a score. Returns the
    report.
    """
    with sized_for(spark, current_path(spark, silver_zone, PATIENTS.name)):
        return _fit_and_report(spark, silver_zone, out, trees, depth, threshold)


def _fit_and_report(
    spark: SparkSession, silver_zone: str, out: str, trees: int, depth: int, threshold: float
) -> DataFrame:
    patients = read_curated(spark, silver_zone, PATIENTS)
    columns = ["patient_id", *CATEGORICAL, *NUMERIC, TARGET]
    marked = keep(stratified_split(patients.select(*columns), TARGET), "split")
    train, test = marked.where("not is_test"), marked.where("is_test").drop("is_test")
    logistic = train_logistic(train, TARGET, CATEGORICAL, NUMERIC)
    forest = train_forest(train, TARGET, CATEGORICAL, NUMERIC, trees, depth)

    models = {"logistic": logistic, "forest": forest}
    scored = score_all(models, test, f"{out}/predictions")
    importance = feature_importance(forest, NUMERIC, scored)
    document = report(scored, patients, TARGET, "logistic", "forest", importance)
    write_json(document, f"{out}/report")
    write_parquet(top_k(importance, "importance", 12, ["feature"]), f"{out}/top_features")
    for name in models:
        write_parquet(roc_curve(scored, TARGET, f"{name}_score"), f"{out}/roc_{name}")
    high_risk(score(forest, patients), f"{out}/high_risk", threshold)
    return spark.read.schema(document.schema).json(f"{out}/report")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train, evaluate and apply the readmission model")
    parser.add_argument("--silver", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--trees", type=int, default=300)
    parser.add_argument("--depth", type=int, default=8)
    parser.add_argument("--threshold", type=float, default=0.5)
    args = parser.parse_args(argv)
    spark = build_session("strandline-readmission")
    readmission_run(spark, args.silver, args.out, args.trees, args.depth, args.threshold)


if __name__ == "__main__":
    main()
