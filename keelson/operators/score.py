"""Scoring: fitted pipelines, a closed-form linear scorer and id baselines.

All scorers are narrow transformations; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import logistic

# Decision threshold of the binary scorers.
THRESHOLD = 0.5


def score_batch(model, raw: DataFrame, id_col: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw rows → ``id, prediction, probability`` (probability of class 1)
    with the same fitted pipeline used in training (imputation, indexing and
    assembly included)."""
    out = model.transform(raw)
    return out.select(id_col, *keep, F.col("prediction"),
                      vector_to_array(F.col("probability"))[1].alias("probability"))


def score_many(models: Mapping[str, object], raw: DataFrame, keep: tuple[str, ...] = ("id",),
               outputs: tuple[str, ...] = ("prediction", "probability")) -> DataFrame:
    """Outputs of several fitted pipelines for the same rows in one narrow
    pass (no join, one scan): the raw columns are carried through each model
    under private names and restored for the next. Columns are named
    ``<model>_prediction`` / ``<model>_probability`` (probability of class 1)."""
    cols = raw.columns
    done: list[str] = []
    cur = raw
    for name, model in models.items():
        carried = cur.select(*cols, *done, *[F.col(c).alias(f"__raw_{c}") for c in cols])
        out = model.transform(carried)
        produced = []
        if "prediction" in outputs:
            produced.append(F.col("prediction").alias(f"{name}_prediction"))
        if "probability" in outputs:
            produced.append(vector_to_array(F.col("probability"))[1].alias(f"{name}_probability"))
        cur = out.select(*[F.col(f"__raw_{c}").alias(c) for c in cols], *done, *produced)
        done += [f"{name}_{o}" for o in outputs]
    return cur.select(*keep, *done)


def score_pair(model_a, model_b, raw: DataFrame, id_col: str = "id",
               names: tuple[str, str] = ("p_a", "p_b")) -> DataFrame:
    """Probabilities of two fitted pipelines for the same rows in one pass."""
    both = score_many({"a": model_a, "b": model_b}, raw, keep=(id_col,), outputs=("probability",))
    return both.select(id_col, F.col("a_probability").alias(names[0]), F.col("b_probability").alias(names[1]))


def score_linear(df: DataFrame, coefficients: Mapping[str, float], intercept: float,
                 threshold: float = THRESHOLD, id_col: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Logistic scoring rule ``p = 1 / (1 + e^-(b0 + b·x))``, class 1 when
    ``p > threshold`` — the rule a fitted binomial logistic regression applies."""
    z = F.lit(float(intercept))
    for c, b in coefficients.items():
        z = z + F.lit(float(b)) * F.col(c).cast("double")
    p = logistic(z)
    return df.select(id_col, *keep, p.alias("probability"),
                     (p > F.lit(float(threshold))).cast("double").alias("prediction"))


def linear_parameters(lr_model, feature_names) -> tuple[dict[str, float], float]:
    """Coefficients and intercept of a fitted binomial logistic regression."""
    coef = lr_model.coefficients.toArray().tolist()
    return dict(zip(feature_names, coef)), float(lr_model.intercept)


def baseline_mod(df: DataFrame, k: int = 3, id_col: str = "id", out: str = "prediction") -> DataFrame:
    """``1`` when ``id mod k == 0`` else ``0``."""
    return df.select(id_col, (F.pmod(F.col(id_col), F.lit(k)) == 0).cast("int").alias(out))


def baseline_alternating(df: DataFrame, start: int = 0, id_col: str = "id", out: str = "prediction") -> DataFrame:
    """0/1 alternating along consecutive ids, starting with 0 at ``start``."""
    return df.select(id_col, F.pmod(F.col(id_col) - F.lit(start), F.lit(2)).cast("int").alias(out))


def baseline_constant(df: DataFrame, value: int = 0, id_col: str = "id", out: str = "prediction") -> DataFrame:
    return df.select(id_col, F.lit(value).cast("int").alias(out))


def prediction_summary(pred: DataFrame, algorithm: str, prediction_col: str = "prediction") -> DataFrame:
    """``algorithm, n_predictions, positive_rate`` in one aggregation."""
    return pred.agg(F.lit(algorithm).alias("algorithm"),
                    F.count(F.lit(1)).alias("n_predictions"),
                    F.avg(F.col(prediction_col).cast("double")).alias("positive_rate"))
