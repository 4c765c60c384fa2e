"""Split, weights, encoding, training, scores and metrics.

Metrics, report and high-risk rows have SQL twins on a rule score. What a fitted model
gives is compared by what must hold for it: its features, and the properties of a
solution, each computed from the rows the model was fitted to or applied to.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import flag, rule_score
from strandline.models.features import FEATURES, feature_names, feature_stages
from strandline.models.levels import encoded_rows, level_table
from strandline.models.scoring import high_risk, report, score
from strandline.models.training import feature_importance, train_forest, train_logistic, weighted
from strandline.models.trees import forest_scores, node_importance, node_table
from strandline.operators.evaluate import accuracy, confusion, roc_auc, roc_curve
from strandline.operators.split import class_weights, stratified_split
from strandline.plans.catalogue.inputs import given
from strandline.session import keep, scratch_path
from strandline.sources.zones import write_json

TARGET, CATEGORICAL, NUMERIC = "quality", ["lang", "source"], ["n_chars"]


def split_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, "o_orderstatus", ["o_orderkey"])


SPLIT = """
SELECT o_orderkey, o_orderstatus,
       ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)))
       <= floor(COUNT(*) OVER (PARTITION BY o_orderstatus) * 0.25::DOUBLE + 0.5) AS is_test
FROM orders
"""


def weights_query(spark: SparkSession, folder: str) -> DataFrame:
    return class_weights(given(spark, folder, "lineitem"), "l_returnflag")


WEIGHTS = """
SELECT l_returnflag, COUNT(*) AS class_rows,
       (SELECT COUNT(*) FROM lineitem) * 1.0::DOUBLE
       / ((SELECT COUNT(DISTINCT l_returnflag) FROM lineitem) * COUNT(*)) AS weight
FROM lineitem GROUP BY l_returnflag
"""


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents").select("doc_id", *CATEGORICAL)
    levels = keep(level_table(documents, CATEGORICAL), "level-table")
    return encoded_rows(documents, levels, CATEGORICAL, "doc_id")


ONE_HOT = """
WITH items AS (
  SELECT doc_id, 1 AS place, 'lang' AS feature, lang AS level FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT doc_id, 2, 'source', source FROM documents WHERE source IS NOT NULL
)
SELECT doc_id, feature, level, DENSE_RANK() OVER (ORDER BY place, level) - 1 AS slot FROM items
"""


def rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    bonuses = [(F.col("l_quantity") > 40, 0.125), (F.col("l_discount") >= 0.07, 0.05)]
    rule = rule_score("l_linestatus", {"F": 0.22, "O": 0.12}, bonuses, cap=0.65)
    value = rule + F.col("l_extendedprice") / F.lit(1000000.0)
    return given(spark, folder, "lineitem").select(
        flag(F.col("l_returnflag") == "R").alias("label"),
        value.alias("score"),
        (value >= 0.3).cast("int").alias("prediction"),
    )


RULE_SCORED = """
  SELECT label, score, CAST(score >= 0.3 AS INTEGER) AS prediction
  FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
               LEAST(0.65::DOUBLE, CASE l_linestatus WHEN 'F' THEN 0.22::DOUBLE ELSE 0.12::DOUBLE END
                 + CASE WHEN l_quantity > 40 THEN 0.125::DOUBLE ELSE 0.0::DOUBLE END
                 + CASE WHEN l_discount >= 0.07 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END)
               + l_extendedprice / 1000000.0::DOUBLE AS score
        FROM lineitem)
"""


def accuracy_query(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy(rule_scored(spark, folder), "label", "prediction")


ACCURACY = f"SELECT AVG(CAST(label = prediction AS INTEGER)) AS accuracy FROM ({RULE_SCORED})"


def confusion_query(spark: SparkSession, folder: str) -> DataFrame:
    return confusion(rule_scored(spark, folder), "label", "prediction")


CONFUSION = f"""
SELECT label, COUNT(*) FILTER (prediction = 0) AS predicted_0, COUNT(*) FILTER (prediction = 1) AS predicted_1
FROM ({RULE_SCORED}) GROUP BY label
"""


def auc_query(spark: SparkSession, folder: str) -> DataFrame:
    return roc_auc(rule_scored(spark, folder), "label", "score")


def curve_query(spark: SparkSession, folder: str) -> DataFrame:
    return roc_curve(rule_scored(spark, folder), "label", "score")


RUNNING = f"""
  SELECT score, pos, neg, SUM(pos) OVER down AS tp, SUM(neg) OVER down AS fp,
         SUM(pos) OVER () AS positives, SUM(neg) OVER () AS negatives
  FROM (SELECT score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg
        FROM ({RULE_SCORED}) GROUP BY score)
  WINDOW down AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
"""

ROC_AUC = f"""
SELECT CAST(SUM(pos * (2 * (negatives - fp) + neg)) AS DOUBLE)
       / (2.0::DOUBLE * CAST(MAX(positives) AS DOUBLE) * CAST(MAX(negatives) AS DOUBLE)) AS roc_auc
FROM ({RUNNING})
"""

ROC_CURVE = f"""
SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score, CAST(fp AS DOUBLE) / CAST(negatives AS DOUBLE), CAST(tp AS DOUBLE) / CAST(positives AS DOUBLE)
FROM ({RUNNING})
"""


# --- report and high-risk rows of the rule score ---


def metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of two rules, stored as JSON and read back, in flat columns."""
    lines = given(spark, folder, "lineitem")
    rows = rule_scored(spark, folder).select(
        "label",
        F.col("score").alias("lr_score"),
        F.col("prediction").alias("lr_prediction"),
        (F.col("score") * -1).alias("rf_score"),
        (F.col("score") < 0.25).cast("int").alias("rf_prediction"),
    )
    stored = keep(rows, "predictions")
    importance = lines.groupBy(F.col("l_shipdate").cast("date").cast("string").alias("feature")).agg(
        F.count(F.lit(1)).cast("double").alias("importance")
    )
    out = report(stored, stored, "label", "lr", "rf", importance)
    path = scratch_path(spark, "report")
    write_json(out, path)
    document = spark.read.schema(out.schema).json(path)
    matrix = [F.col("confusion_matrix_rf")[i][j].alias(f"matrix_{i}{j}") for i in (0, 1) for j in (0, 1)]
    top = F.transform("top_features", lambda x: F.concat_ws(":", x["feature"], x["importance"].cast("long")))
    return document.select(
        *[F.col(f"{m}.{x}").alias(f"{m}_{x}") for m in ("logistic_regression", "random_forest") for x in ("accuracy", "roc_auc")],
        *matrix,
        "test_size",
        "scored_size",
        "positive_rate",
        F.concat_ws(" ", top).alias("top_features"),
    )


METRICS_REPORT = f"""
WITH scored AS ({RULE_SCORED}), points AS ({RUNNING}),
area AS (SELECT CAST(SUM(pos * (2 * (negatives - fp) + neg)) AS DOUBLE)
         / (2.0::DOUBLE * CAST(MAX(positives) AS DOUBLE) * CAST(MAX(negatives) AS DOUBLE)) AS auc FROM points),
best AS (SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS feature, COUNT(*) AS importance
         FROM lineitem GROUP BY 1 ORDER BY importance DESC, feature LIMIT 6)
SELECT ROUND(AVG(CAST(label = prediction AS INTEGER)), 3) AS logistic_regression_accuracy,
       ROUND((SELECT auc FROM area), 3) AS logistic_regression_roc_auc,
       ROUND(AVG(CAST(label = CAST(score < 0.25 AS INTEGER) AS INTEGER)), 3) AS random_forest_accuracy,
       ROUND(1 - (SELECT auc FROM area), 3) AS random_forest_roc_auc,
       COUNT(*) FILTER (label = 0 AND NOT score < 0.25) AS matrix_00,
       COUNT(*) FILTER (label = 0 AND score < 0.25) AS matrix_01,
       COUNT(*) FILTER (label = 1 AND NOT score < 0.25) AS matrix_10,
       COUNT(*) FILTER (label = 1 AND score < 0.25) AS matrix_11,
       COUNT(*) AS test_size, COUNT(*) AS scored_size, ROUND(AVG(label), 3) AS positive_rate,
       (SELECT string_agg(feature || ':' || importance, ' ' ORDER BY importance DESC, feature DESC) FROM best)
       AS top_features
FROM scored
"""


def high_risk_query(spark: SparkSession, folder: str) -> DataFrame:
    return high_risk(rule_scored(spark, folder), scratch_path(spark, "high_risk"), 0.3)


HIGH_RISK = f"SELECT * FROM ({RULE_SCORED}) WHERE score >= 0.3"


# --- fitted models: documents with a quality label ---


def model_input(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents").select("doc_id", *CATEGORICAL, *NUMERIC)
    labels = given(spark, folder, "labels").select("doc_id", TARGET)
    return documents.join(labels, "doc_id")


MODEL_SPLIT = f"""
  SELECT *, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)))
         <= floor(COUNT(*) OVER (PARTITION BY quality) * 0.25::DOUBLE + 0.5) AS is_test
  FROM (SELECT doc_id, lang, source, n_chars, quality FROM documents JOIN labels USING (doc_id))
"""

# the slots of the feature vector of what the model was fitted to
SLOTS = f"""
  SELECT DISTINCT 'lang_' || lang AS feature FROM ({MODEL_SPLIT}) WHERE NOT is_test
  UNION SELECT DISTINCT 'source_' || source FROM ({MODEL_SPLIT}) WHERE NOT is_test
  UNION SELECT 'n_chars'
"""


def split_input(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, stored once as the fits read them many times."""
    stored = keep(stratified_split(model_input(spark, folder), TARGET, ["doc_id"]), "split")
    return stored.where("not is_test").drop("is_test"), stored.where("is_test").drop("is_test")


def features_query(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, feature, value) of the non-zero slots of the feature vectors."""
    rows = model_input(spark, folder)
    model = Pipeline(stages=feature_stages(CATEGORICAL, NUMERIC)).fit(rows)
    names = F.array(*[F.lit(n) for n in feature_names(model, NUMERIC)])
    slots = F.arrays_zip(names.alias("feature"), vector_to_array(FEATURES).alias("value"))
    filled = F.filter(slots, lambda s: s["value"] != 0)
    return model.transform(rows).select("doc_id", F.inline(filled))


FEATURE_ROWS = """
WITH rows AS (SELECT doc_id, lang, source, n_chars FROM documents JOIN labels USING (doc_id))
SELECT doc_id, 'lang_' || lang AS feature, 1.0::DOUBLE AS value FROM rows
UNION ALL SELECT doc_id, 'source_' || source, 1.0::DOUBLE FROM rows
UNION ALL SELECT doc_id, 'n_chars', CAST(n_chars AS DOUBLE) FROM rows WHERE n_chars <> 0
"""


def train_lr(spark: SparkSession, folder: str) -> DataFrame:
    """Per coefficient whether the objective's slope is zero there, as it is at the solution.

    The slope is taken in one pass over the rows the model was fitted to, relative to what a
    change of all residuals would give.
    """
    train, _ = split_input(spark, folder)
    model = train_logistic(train, TARGET, CATEGORICAL, NUMERIC)
    fitted, names = model.stages[-1], feature_names(model, NUMERIC)
    rows, n = weighted(train, TARGET, NUMERIC)
    x = vector_to_array(FEATURES)
    residual = F.col("class_weight") * (vector_to_array("probability")[1] - F.col("label"))
    scored = model.transform(rows).select(x.alias("x"), residual.alias("r"), "class_weight")
    sums = scored.agg(
        *[F.sum(F.col("r") * F.col("x")[i]).alias(f"g{i}") for i in range(len(names))],
        *[F.sum(F.col("class_weight") * F.abs(F.col("x")[i])).alias(f"s{i}") for i in range(len(names))],
        F.sum("r").alias("g_intercept"),
        F.sum("class_weight").alias("s_intercept"),
    )
    pairs = [
        F.struct(
            F.lit(name).alias("feature"),
            # the penalty of half the squared coefficients
            (F.abs(F.col(f"g{i}") + float(beta)) <= SLOPE * F.col(f"s{i}")).alias("settled"),
        )
        for i, (name, beta) in enumerate(zip(names, fitted.coefficients.toArray()))
    ]
    pairs.append(
        F.struct(
            F.lit("intercept").alias("feature"),
            (F.abs("g_intercept") <= SLOPE * F.col("s_intercept")).alias("settled"),
        )
    )
    return sums.select(F.inline(F.array(*pairs)))


SLOPE = 1e-3
TRAIN_LR = f"SELECT feature, TRUE AS settled FROM ({SLOTS}) UNION ALL SELECT 'intercept', TRUE"


def forest(spark: SparkSession, folder: str):
    train, test = split_input(spark, folder)
    return train_forest(train, TARGET, CATEGORICAL, NUMERIC), test


def train_rf(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows, and whether prediction and score are what the forest's node table gives."""
    model, test = forest(spark, folder)
    own = score(model, test).select("doc_id", F.col(TARGET).alias("label"), "prediction", "score")
    nodes = node_table(spark, model)
    found = forest_scores(model, nodes, test, "doc_id", "node_")
    return own.join(found, "doc_id", "left").select(
        "doc_id",
        "label",
        "trees",
        F.coalesce(F.abs(F.col("score") - F.col("node_score")) < 1e-9, F.lit(False)).alias("score_agrees"),
        # equal votes are a tie that rounding may break either way
        F.coalesce(
            (F.col("prediction") == F.col("node_prediction")) | (F.abs(F.col("node_score") - 0.5) < 1e-9), F.lit(False)
        ).alias("prediction_agrees"),
    )


TRAIN_RF = f"""
SELECT doc_id, quality AS label, 300::BIGINT AS trees, TRUE AS score_agrees, TRUE AS prediction_agrees
FROM ({MODEL_SPLIT}) WHERE is_test
"""


def forest_root(spark: SparkSession, folder: str) -> DataFrame:
    """The one split of a tree of depth 1 over all rows and categories: gain, and class weights on either side."""
    rows = keep(model_input(spark, folder), "model-input")
    model = train_forest(rows, TARGET, CATEGORICAL, [], trees=1, depth=1, bootstrap=False)
    nodes = node_table(spark, model)
    names = F.array(*[F.lit(n) for n in feature_names(model, [])])
    root = nodes.where("feature IS NOT NULL").select(
        F.get(names, F.col("feature")).alias("feature"), F.round("gain", 6).alias("gain"), "left_values",
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("left"), F.col("left_node").alias("child")),
                F.struct(F.lit(False).alias("left"), F.col("right_node").alias("child")),
            )
        ),
    )
    ends = nodes.select(F.col("node").alias("child"), "votes", "rows")
    # the slot's value on this side: that of the left values, or the other one
    value = F.when(F.col("left") == F.array_contains("left_values", F.lit(1.0)), 1).otherwise(0)
    return root.join(ends, "child").select(
        "feature", "gain", value.alias("value"), "rows",
        *[F.round(F.get("votes", F.lit(i)), 6).alias(f"weight_{i}") for i in (0, 1)],
    )


FOREST_ROOT = """
WITH rows AS (SELECT lang, source, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
weighted AS (
  SELECT *, (SELECT COUNT(*) FROM rows) / (2.0::DOUBLE * COUNT(*) OVER (PARTITION BY quality)) AS w FROM rows
), slots AS (
  SELECT DISTINCT 1 AS part, lang AS level FROM rows WHERE lang IS NOT NULL
  UNION ALL SELECT DISTINCT 2, source FROM rows WHERE source IS NOT NULL
), sides AS (
  SELECT part, level, CASE WHEN coalesce(CASE part WHEN 1 THEN lang ELSE source END = level, FALSE) THEN 1 ELSE 0 END AS value,
         COUNT(*) AS n, SUM(CASE WHEN quality = 0 THEN w ELSE 0 END) AS w0, SUM(CASE WHEN quality = 1 THEN w ELSE 0 END) AS w1
  FROM weighted CROSS JOIN slots GROUP BY 1, 2, 3
), impure AS (
  SELECT *, w0 + w1 AS w, 1 - (w0 * w0 + w1 * w1) / ((w0 + w1) * (w0 + w1)) AS gini FROM sides
), gains AS (
  SELECT part, level,
         1 - (SUM(w0) * SUM(w0) + SUM(w1) * SUM(w1)) / (SUM(w) * SUM(w)) - SUM(w * gini) / SUM(w) AS gain
  FROM impure GROUP BY part, level HAVING COUNT(*) = 2
), best AS (SELECT * FROM gains ORDER BY ROUND(gain, 12) DESC, part, level LIMIT 1)
SELECT CASE part WHEN 1 THEN 'lang_' ELSE 'source_' END || level AS feature, ROUND(gain, 6) AS gain, value, n AS rows,
       ROUND(w0, 6) AS weight_0, ROUND(w1, 6) AS weight_1
FROM best JOIN impure USING (part, level)
"""


def score_query(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows, and whether score and prediction are what the coefficients say."""
    train, test = split_input(spark, folder)
    model = train_logistic(train, TARGET, CATEGORICAL, NUMERIC)
    fitted, names = model.stages[-1], feature_names(model, NUMERIC)
    beta = dict(zip(names, fitted.coefficients.toArray().tolist()))

    def part(c: str):
        known = [x for name, b in beta.items() if name.startswith(f"{c}_") for x in (F.lit(name), F.lit(b))]
        return F.coalesce(F.element_at(F.create_map(*known), F.concat(F.lit(f"{c}_"), c)), F.lit(0.0))

    margin = part("lang") + part("source") + F.col("n_chars") * beta["n_chars"] + float(fitted.intercept)
    expected = 1 / (1 + F.exp(-margin))
    return score(model, test).select(
        "doc_id",
        (F.abs(F.col("score") - expected) < 1e-9).alias("score_agrees"),
        (F.col("prediction") == (expected > 0.5).cast("int")).alias("prediction_agrees"),
    )


SCORE = f"SELECT doc_id, TRUE AS score_agrees, TRUE AS prediction_agrees FROM ({MODEL_SPLIT}) WHERE is_test"


def importance_query(spark: SparkSession, folder: str) -> DataFrame:
    """Per slot whether its importance is what the gains of the forest's nodes give, and the sum over all slots."""
    model, test = forest(spark, folder)
    ranked = feature_importance(model, NUMERIC, test)
    found = node_importance(spark, model, node_table(spark, model)).withColumnRenamed("importance", "of_nodes")
    whole = ranked.agg(F.round(F.sum("importance"), 9)).scalar()
    agrees = F.coalesce(F.abs(F.col("importance") - F.col("of_nodes")) < 1e-9, F.lit(False))
    return ranked.join(found, "feature", "left").select("feature", agrees.alias("agrees"), whole.alias("total"))


IMPORTANCE = f"SELECT feature, TRUE AS agrees, 1.0::DOUBLE AS total FROM ({SLOTS})"


ENTRIES = {
    "stratified_split": (split_query, SPLIT),
    "class_weights": (weights_query, WEIGHTS),
    "one_hot": (one_hot, ONE_HOT),
    "accuracy": (accuracy_query, ACCURACY),
    "confusion": (confusion_query, CONFUSION),
    "roc_auc": (auc_query, ROC_AUC),
    "roc_curve": (curve_query, ROC_CURVE),
    "features": (features_query, FEATURE_ROWS),
    "train_lr": (train_lr, TRAIN_LR),
    "train_rf": (train_rf, TRAIN_RF),
    "forest_root": (forest_root, FOREST_ROOT),
    "score": (score_query, SCORE),
    "feature_importance": (importance_query, IMPORTANCE),
    "metrics_report": (metrics_report, METRICS_REPORT),
    "high_risk": (high_risk_query, HIGH_RISK),
}
