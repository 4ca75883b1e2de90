"""Scores of predictions: confusion counts, reports, ROC curves, regression errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_number, col, rows_of
from ..functions.ordering import WINDOW_ROWS, running_sums
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles
from ..functions.storage import cut_lineage
from .split import SPLIT, TRAIN

# A matrix has one column per label; more is an error, not a cut.
MAX_MATRIX_LABELS = 1_000
# Fixed value: a train score this far above the fold mean counts as overfitting.
OVERFIT_GAP = 0.15


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``actual, predicted, n`` for the pairs that occur. All class scores derive from it."""
    return df.groupBy(col(actual).alias("actual"), col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_scores(counts: DataFrame) -> DataFrame:
    """``label, hits, support, called, precision, recall, f1`` per label seen on either side."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    long = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), hit.alias("hits"), F.col("n").alias("support"), none.alias("called")),
                F.struct(F.col("predicted").alias("label"), none.alias("hits"), none.alias("support"), F.col("n").alias("called")),
            )
        )
    )
    sums = long.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("hits", "support", "called")])
    return _with_scores(sums)


def _with_scores(sums: DataFrame) -> DataFrame:
    p = _ratio(F.col("hits"), F.col("called"))
    r = _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(F.col("hits") * 2, F.col("called") + F.col("support"))
    return sums.select("*", p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def classification_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", n_classes: int | None = None
) -> DataFrame:
    """One row: accuracy, precision, recall, f1 and the average used.

    Two classes: scores of the second label in sorted order. More: plain means over the
    labels that occur. Nothing to divide by counts as zero.
    """
    scores = class_scores(confusion_counts(df, actual, predicted))
    names = ("precision", "recall", "f1")
    second = F.max_by(F.struct(*names), F.col("label"))
    classes = (
        F.count(F.when(F.col("support") > 0, 1)) if n_classes is None else F.lit(n_classes)
    )
    wide = scores.agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        second.alias("_second"), classes.alias("_classes"),
        *[F.avg(n).alias(f"_{n}") for n in names],
    )
    binary = F.col("_classes") == 2
    return wide.select(
        "accuracy",
        *[F.when(binary, F.col(f"_second.{n}")).otherwise(F.col(f"_{n}")).alias(n) for n in names],
        F.when(binary, "binary").otherwise("macro").alias("average"),
    )


def classification_report(
    df: DataFrame, labels: list | None = None, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages.

    ``labels`` are the trained classes; one that never occurs counts as a row of zeros.
    """
    scores = class_scores(confusion_counts(df, actual, predicted))
    scores = scores.withColumn("class", F.col("label").cast("string"))
    if labels is not None:
        every = df.sparkSession.createDataFrame([(str(x),) for x in labels], "class string")
        scores = every.join(scores, "class", "left").na.fill(
            0, ["hits", "support", "called", "precision", "recall", "f1"]
        )
    names = ("precision", "recall", "f1")
    per_class = scores.select("class", *names, "support")
    sums = per_class.agg(
        *[F.avg(n).alias(f"m_{n}") for n in names],
        *[_ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(f"w_{n}") for n in names],
        F.sum("support").alias("support"),
    )
    averages = sums.select(
        rows_of(
            [
                {"class": F.lit(label), **{n: F.col(f"{k}_{n}") for n in names}, "support": F.col("support")}
                for label, k in (("Macro average", "m"), ("Weighted average", "w"))
            ]
        )
    )
    return per_class.unionByName(averages)


def confusion_matrix(
    df: DataFrame, labels: list | None = None, actual: str = "actual", predicted: str = "predicted",
    max_labels: int = MAX_MATRIX_LABELS,
) -> DataFrame:
    """One row ``Actual x`` per label, one column ``Predicted y`` per label, zeros filled in.

    Each label is a column: more than ``max_labels`` are refused. ``confusion_counts`` has
    the same numbers in long form, without a bound.
    """
    counts = confusion_counts(df, actual, predicted).select(
        F.col("actual").cast("string").alias("a"), F.col("predicted").cast("string").alias("p"), "n"
    )
    if labels is None:
        seen = counts.select(F.explode(F.array("a", "p")).alias("x")).distinct()
        labels = sorted(r[0] for r in seen.limit(max_labels + 1).collect())
    if len(labels) > max_labels:
        raise ValueError(f"More than {max_labels} labels; allow more with `max_labels`, or use the counts.")
    names = [str(x) for x in labels]
    every = df.sparkSession.createDataFrame([(x,) for x in names], "a string")
    cells = [
        F.coalesce(F.sum(F.when(F.col("p") == x, F.col("n"))), F.lit(0)).alias(f"Predicted {x}")
        for x in names
    ]
    return (
        every.join(counts, "a", "left")
        .groupBy("a").agg(*cells)
        .withColumn("a", F.concat(F.lit("Actual "), "a"))
        .withColumnRenamed("a", "actual")
    )


def one_vs_rest(df: DataFrame, classes: list, actual: str, probability: str) -> DataFrame:
    """``class, score, positive``: each class's probability against its own label value.

    ``probability`` is an array in the order of ``classes``; a class is matched by value.
    """
    cells = [
        F.struct(
            F.lit(str(c)).alias("class"),
            F.col(probability)[i].alias("score"),
            F.coalesce(col(actual) == F.lit(c), F.lit(False)).alias("positive"),
        )
        for i, c in enumerate(classes)
    ]
    return df.select(F.inline(F.array(*cells)))


def _cumulated(scored: DataFrame, by: list[str], window_rows: int) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the top down."""
    groups = cut_lineage(
        scored.groupBy(*by, "score").agg(
            F.count(F.when(F.col("positive"), 1)).alias("pos"),
            F.count(F.when(~F.col("positive"), 1)).alias("neg"),
        )
    )
    return running_sums(groups, by, ["score"], ["pos", "neg"], groups.count(), window_rows, descending=True)


def roc_points(
    scored: DataFrame, by: tuple[str, ...] = ("class",), window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """``class, threshold, fpr, tpr``: every point of the curve, the origin included.

    Classes without a positive row have no curve.
    """
    by = list(by)
    running = _cumulated(scored, by, window_rows).filter("all_pos > 0")
    share = {
        "fpr": F.try_divide(F.col("cum_neg").cast("double"), F.col("all_neg").cast("double")),
        "tpr": F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos").cast("double")),
    }
    point = F.struct(F.col("score").alias("threshold"), *[v.alias(n) for n, v in share.items()])
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    # The highest score of a class also brings the start of its curve.
    highest = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    return running.select(
        *by, F.inline(F.when(highest, F.array(origin, point)).otherwise(F.array(point)))
    )


def roc_auc(
    scored: DataFrame, by: tuple[str, ...] = ("class",), window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """``class, auc`` by rank sums, ties counting half; NULL when a side is empty."""
    by = list(by)
    running = _cumulated(scored, by, window_rows)
    # Pairs in which the positive row scores higher, plus half of those that tie.
    above = F.col("cum_pos") - F.col("pos") + F.col("pos") / F.lit(2.0)
    return running.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("neg") * above),
            F.sum("pos").cast("double") * F.sum("neg").cast("double"),
        ).alias("auc")
    )


def roc_auc_brief(
    df: DataFrame, classes: list, actual: str = "actual", probability: str = "probability",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """One AUC: of the second label for two classes, else the mean over all classes.

    NULL when there is one class only, or when a class does not occur in the rows.
    """
    if len(classes) < 2:
        return df.sparkSession.createDataFrame([(None,)], "auc double")
    scored = one_vs_rest(df, classes, actual, probability)
    if len(classes) == 2:
        scored = scored.filter(F.col("class") == str(classes[1]))
    per_class = roc_auc(scored, window_rows=window_rows)
    return per_class.agg(
        F.when(F.count(F.when(F.col("auc").isNull(), 1)) == 0, F.avg("auc")).alias("auc")
    )


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: mae, mse, rmse, r2. R2 of a constant target: 1 when every row is hit, else 0."""
    y, p = as_number(df, actual), as_number(df, predicted)
    e = y - p
    wide = df.agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.when(F.min(y) < F.max(y), F.var_pop(y)).alias("_var"),
    )
    r2 = F.when(F.col("_var").isNotNull(), F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var")))
    flat = F.when(F.col("mse") == 0, F.lit(1.0)).when(F.col("mse").isNotNull(), F.lit(0.0))
    return wide.select("mae", "mse", F.sqrt("mse").alias("rmse"), F.coalesce(r2, flat).alias("r2"))


def prediction_frame(df: DataFrame, actual: str, predicted: str, keep: list[str] | None = None) -> DataFrame:
    """``actual, predicted, residual`` with residual = actual - predicted."""
    y, p = as_number(df, actual), as_number(df, predicted)
    return df.select(
        *map(col, keep or []), y.alias("actual"), p.alias("predicted"), (y - p).alias("residual")
    )


def residual_statistics(
    predictions: DataFrame, residual: str = "residual", distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """Mean, population std, min, median and max of the residuals."""
    median = column_quantiles(predictions, [residual], [0.5], distinct_limit)[0][residual][0]
    e = as_number(predictions, residual)
    return predictions.agg(
        F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), F.min(e).alias("min"),
        F.max(e).alias("max"),
    ).withColumn("median", F.lit(median).cast("double"))


def ideal_line(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """The ends of the line on which prediction equals truth."""
    y, p = as_number(df, actual), as_number(df, predicted)
    return df.agg(
        F.least(F.min(y), F.min(p)).alias("low"), F.greatest(F.max(y), F.max(p)).alias("high")
    )


def overfitting(df: DataFrame, train_score: str = "train_score", fold_mean: str = "fold_mean") -> DataFrame:
    """Adds the absolute gap, and whether training is ahead by more than the limit."""
    gap = col(train_score) - col(fold_mean)
    return df.select("*", F.abs(gap).alias("gap"), (gap > F.lit(OVERFIT_GAP)).alias("overfits"))


def generalisation(
    scored: DataFrame, task: str = "classification", actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """One row ``train_score, test_score``: accuracy or R2 per side, from one scan."""
    def score(side: Column) -> Column:
        if task == "classification":
            hit = F.when(side, (col(actual) == col(predicted)).cast("double"))
            return F.avg(hit)
        y = F.when(side, as_number(scored, actual))
        e = y - as_number(scored, predicted)
        return F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(y))

    train = F.col(SPLIT) == TRAIN
    return scored.agg(score(train).alias("train_score"), score(~train).alias("test_score"))


def fold_summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Mean, population std, min and max over the folds."""
    s = col(score)
    return scores.agg(
        F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"),
        F.max(s).alias("max"), F.count(s).alias("folds"),
    )
