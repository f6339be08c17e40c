"""Linear classifiers, repeated cross-validation and their evaluation."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators.sampling import fold_numbers
from refrain.session import pin, training_set


def svm_pipeline(
    reg: float = 0.01, max_iter: int = 100, tol: float = 1e-3, center: bool = False
) -> Pipeline:
    """Scale, then a linear support-vector machine. Centring makes sparse vectors dense, so it is
    off unless asked for; the intercept absorbs the shift."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=center, withStd=True)
    svm = LinearSVC(
        featuresCol="scaled", regParam=reg, maxIter=max_iter, tol=tol, standardization=False
    )
    return Pipeline(stages=[scaler, svm])


def logit_pipeline(reg: float = 0.0, max_iter: int = 100) -> Pipeline:
    """Logistic regression; a small ridge is advised when features outnumber rows."""
    return Pipeline(stages=[LogisticRegression(regParam=reg, maxIter=max_iter)])


def train_svm(train: DataFrame, **settings) -> PipelineModel:
    """Fit the support-vector machine on ``(label, features)``."""
    return svm_pipeline(**settings).fit(train)


def train_logit(train: DataFrame, **settings) -> PipelineModel:
    """Fit the logistic regression on ``(label, features)``."""
    return logit_pipeline(**settings).fit(train)


def repeated_cv(
    estimator: Estimator, df: DataFrame, folds: int, repeats: int, seed: int, key: str = "lyrics_id", label: str = "label",
    parallelism: int = 8,
) -> DataFrame:
    """Mean accuracy of a k-fold cross-validation per repeat: ``(repeat, accuracy)``.

    Folds are columns, one per repeat, balanced within each label, of one pinned table; the rows are pinned before they
    get them, since every repeat's numbering reads them. Every fit reads that table with
    a filter on its fold column and runs on the executors; the driver starts ``parallelism`` of them at a time. Spark's
    own cross-validator takes a fold column too, but passes it through a Python function and caches each split: it
    took twice as long.
    """
    df = pin(df)
    for repeat in range(1, repeats + 1):
        numbers = fold_numbers(df, key, label, folds, f"{seed}-fold-{repeat}", f"fold_{repeat}").drop(label)
        df = df.join(numbers, key)
    pinned = training_set(df)
    right = F.avg((F.col(label) == F.col("prediction")).cast("double"))

    def accuracy(split: tuple[int, int]) -> tuple[int, float]:
        repeat, fold = split
        held_out = F.col(f"fold_{repeat}") == fold
        model = estimator.fit(pinned.filter(~held_out))
        return repeat, model.transform(pinned.filter(held_out)).agg(right).first()[0]

    splits = [(repeat, fold) for repeat in range(1, repeats + 1) for fold in range(folds)]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(accuracy, splits, chunksize=1)
    # A fold is empty only if there are fewer rows than folds.
    rows = df.sparkSession.createDataFrame(scores, "repeat int, accuracy double")
    return rows.groupBy("repeat").agg(F.avg("accuracy").alias("accuracy"))


def confusion_matrix(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 0.0
) -> DataFrame:
    """One row: the four cells, accuracy, kappa, sensitivity and specificity.

    ``positive`` is the class that sensitivity is about, by default the lower one.
    """
    is_pos, said_pos = F.col(label) == positive, F.col(prediction) == positive
    cells = pred.agg(
        F.count_if(is_pos & said_pos).alias("tp"),
        F.count_if(~is_pos & said_pos).alias("fp"),
        F.count_if(is_pos & ~said_pos).alias("fn"),
        F.count_if(~is_pos & ~said_pos).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    observed = F.try_divide(tp + tn, n)
    expected = F.try_divide((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    return cells.select(
        "tp",
        "fp",
        "fn",
        "tn",
        observed.alias("accuracy"),
        F.try_divide(observed - expected, 1 - expected).alias("kappa"),
        F.try_divide(tp, tp + fn).alias("sensitivity"),
        F.try_divide(tn, tn + fp).alias("specificity"),
    )
