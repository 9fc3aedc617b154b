"""Case-delay regression on Spark ML (ML-1..7).

Features: categorical columns with at most ``max_categories`` levels (the
most frequent ``max_categories - 1`` kept, the rest grouped into ``OTROS``),
one-hot encoded with unknown levels kept apart, plus numeric columns; a
gradient-boosted tree regressor.  The train/test split hashes a row key, so
it does not depend on partitioning (``randomSplit`` does).  Metrics are
computed on the hold-out rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata.operators.ranks import exact_quantiles
from judicata.session import materialise

OTHER = "OTROS"
# The source model's hyper-parameters, and its automatic
# early stopping (on above 10,000 training rows, 10 % held out for validation).
GBT_PARAMS = {"maxIter": 400, "stepSize": 0.06, "maxDepth": 6}
VALIDATION_PCT = 10
VALIDATION_TOL = 1e-7
#: Training rows of one task; boosting holds a few hundred bytes of a row, and every task reads its rows in every round.
ROWS_A_TASK = 250_000


def key_percent(key_cols, seed: int = 42):
    """0..99 from the first 8 hex digits of an MD5 over seed and key, which other engines can compute too."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % 100


def split(df: DataFrame, key_cols, test_pct: int = 20, seed: int = 42):
    x = df.withColumn("_h", key_percent(key_cols, seed))
    return x.where(F.col("_h") >= test_pct).drop("_h"), x.where(F.col("_h") < test_pct).drop("_h")


def cap_categories(train: DataFrame, cols, max_categories: int = 40):
    """ML-3: per column, the (max_categories - 1) most frequent levels of the training
    data; the lookup is one small aggregate per column (levels, not rows)."""
    keep = {}
    for c in cols:
        freq = train.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        # distributed top-k (each task keeps k rows), also for features with millions of levels
        keep[c] = freq.orderBy(F.col("_n").desc(), F.col(c).asc_nulls_last()).limit(max_categories - 1).select(c)
    return keep


def apply_caps(df: DataFrame, keep: dict) -> DataFrame:
    for c, k in keep.items():
        df = (df.join(k.withColumn(f"_{c}_ok", F.lit(True)), c, "left")
                .withColumn(c, F.when(F.col(f"_{c}_ok"), F.col(c)).otherwise(F.lit(OTHER))).drop(f"_{c}_ok"))
    return df


# ML-3 / ML-4: indexers, one-hot with unknown kept, assembler, gradient-boosted trees
def build_pipeline(cat_cols, num_cols, target: str, seed: int = 42, validation_col: str | None = None, **gbt):
    params = dict(GBT_PARAMS)
    params.update(gbt)
    if validation_col:
        params.update(validationIndicatorCol=validation_col, validationTol=VALIDATION_TOL)
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_i" for c in cat_cols], outputCols=[f"{c}_v" for c in cat_cols],
                        handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_v" for c in cat_cols] + list(num_cols), outputCol="features")
    gbr = GBTRegressor(featuresCol="features", labelCol=target, seed=seed, checkpointInterval=10, **params)
    return Pipeline(stages=[*idx, ohe, asm, gbr])


def fit_dealt(stages, train: DataFrame, key_cols) -> PipelineModel:
    """Fit feature stages and, last, boosted trees whose rows are dealt by key over as many tasks as they need.

    Files are split by their bytes, and a file holds a training row in a few: without this a
    core gets one task, however many rows there are.  All rows are fitted, and each once."""
    features = Pipeline(stages=stages[:-1]).fit(train)
    trees = stages[-1]
    x = features.transform(train)
    rows = train.count()
    if rows > ROWS_A_TASK:
        own = [trees.getFeaturesCol(), trees.getLabelCol()]
        if trees.isDefined(trees.validationIndicatorCol):
            own.append(trees.getValidationIndicatorCol())
        tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))
        x = x.select(*own, *[c for c in key_cols if c not in own]).repartition(tasks, *[F.col(c) for c in key_cols])
    return PipelineModel(stages=[*features.stages, trees.fit(x)])


def fit_and_score(df: DataFrame, key_cols, cat_cols, num_cols, target: str, early_stopping: bool = True,
                  **gbt):
    """Returns (model, test predictions, one-row metrics DataFrame).

    With ``early_stopping`` (whatever the number of rows) a hashed 10 % of the
    training rows is the validation set and boosting stops once the validation
    error stops improving; without it all training rows are fitted."""
    from judicata.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)     # boosting checkpoints its error RDD every 10 rounds
    train, test = split(df, key_cols)
    keep = cap_categories(train, cat_cols)
    train, test = apply_caps(train, keep), apply_caps(test, keep)
    use_val = early_stopping
    vcol = None
    if use_val:
        vcol = "_es_val"
        h = F.pmod(F.xxhash64(F.lit(7), *[F.col(c) for c in key_cols]), F.lit(100))
        train = train.withColumn(vcol, h < VALIDATION_PCT)
    model = fit_dealt(build_pipeline(cat_cols, num_cols, target, validation_col=vcol, **gbt).getStages(), train, key_cols)
    if vcol:
        train = train.drop(vcol)      # n_train and the baseline median cover the whole training split
    # the medians read the predictions more than once
    pred = materialise(model.transform(test).select(*test.columns, "prediction"))
    return model, pred, metrics(train, pred, target)


def exact_median(df: DataFrame, value) -> float | None:
    """Exact median of a column or expression."""
    row = exact_quantiles(df, [], value, (0.5,), ("median",)).first()
    return row.median if row else None


def split_report(train: DataFrame, test: DataFrame, cat_cols, target: str) -> DataFrame:
    """(medida, columna, nivel, valor): sizes of the split, the training median, the error
    of predicting it for every held-out row, and the levels that each category keeps (ML-2, ML-3, ML-5)."""
    median = exact_median(train, target)
    levels = cap_categories(train, cat_cols)
    rows = [train.agg(F.lit("n_train").alias("medida"), F.count(F.lit(1)).cast("double").alias("valor")),
            test.agg(F.lit("n_test").alias("medida"), F.count(F.lit(1)).cast("double").alias("valor")),
            test.agg(F.lit("baseline_mae").alias("medida"), F.avg(F.abs(F.col(target) - F.lit(median).cast("double"))).alias("valor")),
            test.agg(F.lit("mediana").alias("medida"), F.lit(median).cast("double").alias("valor"))]
    rows = [r.select("medida", F.lit(None).cast("string").alias("columna"), F.lit(None).cast("string").alias("nivel"), "valor") for r in rows]
    rows += [kept.select(F.lit("nivel").alias("medida"), F.lit(c).alias("columna"), F.col(c).alias("nivel"), F.lit(None).cast("double").alias("valor"))
             for c, kept in levels.items()]
    return reduce(DataFrame.unionByName, rows)


def metrics(train: DataFrame, pred: DataFrame, target: str) -> DataFrame:
    """MAE, median absolute error, R², MAE of the training median, lift (ML-5, IND-17)."""
    y, p = F.col(target).cast("double"), F.col("prediction")
    med_train = F.lit(exact_median(train, target)).cast("double")
    med_error = F.lit(exact_median(pred, F.abs(y - p))).cast("double")
    ev = RegressionEvaluator(labelCol=target, predictionCol="prediction")
    mae = ev.evaluate(pred, {ev.metricName: "mae"})
    r2 = ev.evaluate(pred, {ev.metricName: "r2"})
    m = pred.agg(F.count(F.lit(1)).alias("n_test"),
                 F.max(med_error).alias("medae"),
                 F.avg(F.abs(y - med_train)).alias("baseline_mae"))
    n_train = train.select(F.count(F.lit(1))).scalar()
    return (m.withColumn("n_train", n_train).withColumn("mae", F.lit(mae)).withColumn("r2", F.lit(r2))
             .withColumn("lift", F.lit(1.0) - F.lit(mae) / F.col("baseline_mae"))
             .select("n_train", "n_test", "mae", "medae", "r2", "baseline_mae", "lift"))


def median_by_group(pred: DataFrame, group: str, target: str) -> DataFrame:
    """Real vs predicted median per process type over hold-out rows (ML-6, TRAP-8)."""
    real = exact_quantiles(pred, group, target, (0.5,), ("real_mediana",))
    return real.join(exact_quantiles(pred, group, "prediction", (0.5,), ("pred_mediana",)).drop("n"), group)


def score_with_fallback(model, rows: DataFrame, fallback: DataFrame, group: str) -> DataFrame:
    """Batch scoring; rows the model cannot score fall back to their group's median (ML-7)."""
    scored = model.transform(rows)
    return (scored.join(fallback.select(group, F.col("real_mediana").alias("_fb")), group, "left")
                  .withColumn("prediccion", F.coalesce(F.col("prediction"), F.col("_fb"))).drop("_fb"))


def psi(a_counts: DataFrame, bucket: str, n_a: str, n_b: str) -> DataFrame:
    """Population stability index per bucket and in total (ML-11):
    sum((a - b) * ln(a / b)) over buckets where both shares are positive."""
    from judicata.operators.windows import with_scalars
    x = with_scalars(a_counts, "_t", ta=F.sum(n_a), tb=F.sum(n_b))
    x = x.withColumn("share_a", F.col(n_a).cast("double") / F.col("_t.ta").cast("double")) \
         .withColumn("share_b", F.col(n_b).cast("double") / F.col("_t.tb").cast("double")).drop("_t")
    x = x.withColumn("psi_i", F.when((F.col("share_a") > 0) & (F.col("share_b") > 0),
                                     (F.col("share_a") - F.col("share_b")) * F.ln(F.col("share_a") / F.col("share_b"))))
    total = x.select(F.sum("psi_i")).scalar()
    return x.withColumn("psi_total", total)


def risk_classifier(df: DataFrame, key_cols, cat_cols, num_cols, target: str, q: float = 0.75, early_stopping: bool = True, **gbt):
    """ML-8: label = target above its training p75; GBT classifier; hold-out AUC."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    train, test = split(df, key_cols)
    h = train.groupBy(F.col(target).cast("long").alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
    thr = h.select(F.percentile("_v", F.lit(q), F.col("_w")).cast("double")).scalar()
    train = train.withColumn("riesgo", (F.col(target) > thr).cast("double"))
    test = test.withColumn("riesgo", (F.col(target) > thr).cast("double"))
    keep = cap_categories(train, cat_cols)
    train, test = apply_caps(train, keep), apply_caps(test, keep)
    pipe = build_pipeline(cat_cols, num_cols, "riesgo", **gbt)
    stages = pipe.getStages()[:-1]
    params = dict(GBT_PARAMS)
    params.update(gbt)
    if early_stopping:
        h = F.pmod(F.xxhash64(F.lit(7), *[F.col(c) for c in key_cols]), F.lit(100))
        train = train.withColumn("_es_val", h < VALIDATION_PCT)
        params.update(validationIndicatorCol="_es_val", validationTol=VALIDATION_TOL)
    clf = GBTClassifier(featuresCol="features", labelCol="riesgo", seed=42, checkpointInterval=10, **params)
    model = fit_dealt([*stages, clf], train, key_cols)
    pred = model.transform(test)
    auc = BinaryClassificationEvaluator(labelCol="riesgo", rawPredictionCol="rawPrediction").evaluate(pred)
    return model, pred, auc


def appeal_model(df: DataFrame, cat_cols, num_cols, label: str):
    """ML-10: appeal / archive probability with logistic regression."""
    from pyspark.ml.classification import LogisticRegression
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_i" for c in cat_cols], outputCols=[f"{c}_v" for c in cat_cols],
                        handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}_v" for c in cat_cols] + list(num_cols), outputCol="features")
    return Pipeline(stages=[*idx, ohe, asm, LogisticRegression(featuresCol="features", labelCol=label)]).fit(df)
