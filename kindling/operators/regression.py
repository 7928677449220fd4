"""Linear regression and classification (REG1-REG3, ML1).

Feature scaling statistics and the SGD sufficient statistics are one
distributed aggregate each; only the resulting handful of scalars reach the
driver. Model fitting uses ``pyspark.ml`` estimators (distributed tree
aggregates), never a driver-side copy of the data.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zscore(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """Add ``(c - mean) / population std`` for each column (one aggregate pass)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    out = df
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0))
    return out


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """SRC11 / ML feature vector via ``VectorAssembler``."""
    return VectorAssembler(inputCols=features, outputCol=out).transform(df)


def fit_elastic_net(train: DataFrame, features: list[str], label: str, reg: float = 0.3,
                    elastic_net: float = 0.8, max_iter: int = 100, tol: float = 1e-6,
                    solver: str | None = None):
    """REG2: ``LinearRegression`` with the reference's settings; returns the model.

    With few features (at most 4096) the ``normal`` solver is used: one
    distributed pass aggregates the k x k normal equations, and the same
    elastic-net objective is solved on that small system on the driver,
    instead of one pass over the data per iterative (OWLQN) step.
    """
    solver = solver or ("normal" if len(features) <= 4096 else "l-bfgs")
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg,
                          elasticNetParam=elastic_net, maxIter=max_iter, tol=tol, solver=solver)
    return lr.fit(assemble(train, features))


def predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    """REG3: score rows; each prediction stays in the row with its label."""
    return model.transform(assemble(df, features))


def sgd_least_squares(df: DataFrame, x: str, y: str, iterations: int = 100, step: float = 1.0,
                      reg: float = 0.01, tol: float = 0.001):
    """REG1: one-feature linear regression by full-batch gradient descent with
    a squared-L2 updater, no intercept (the reference's ``LinearRegressionWithSGD``).

    With full batches the gradient at ``w`` is ``w*E[x^2] - E[xy]``, so one
    aggregate gives everything; the 100-step recursion runs on two scalars:
    ``w <- w(1 - s*reg) - s*(w*E[x^2] - E[xy])``, ``s = step/sqrt(t)``, stopping
    from step 2 on when ``|dw| < tol * max(|w|, 1)``. Returns ``(weight, steps)``.
    """
    st = df.agg(F.avg(F.col(x) * F.col(x)).alias("exx"), F.avg(F.col(x) * F.col(y)).alias("exy")).first()
    exx, exy = float(st["exx"]), float(st["exy"])
    w, steps = 0.0, 0
    for t in range(1, iterations + 1):
        s = step / math.sqrt(t)
        new = w * (1.0 - s * reg) - s * (w * exx - exy)
        steps = t
        done = t >= 2 and abs(new - w) < tol * max(abs(new), 1.0)
        w = new
        if done:
            break
    return w, steps


def sgd_gram(df: DataFrame, features: list[str], label: str, iterations: int = 100, step: float = 1.0, reg: float = 0.01, tol: float = 0.001):
    """REG1 for several features: :func:`sgd_least_squares` with a weight vector.

    The full-batch gradient at ``w`` is ``G w - h`` with the Gram matrix ``G = E[x x']`` and ``h = E[x y]``,
    so one aggregate of k (k + 3) / 2 means (the matrix is symmetric) gives all that
    the recursion needs; the steps run on these numbers alone. It stops from
    step 2 on when ``|dw| < tol * max(|w|, 1)``, in Euclidean norms. Returns ``(weights, steps)``."""
    k = len(features)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    means = [F.avg(F.col(features[i]) * F.col(features[j])) for i, j in upper] + [F.avg(F.col(f) * F.col(label)) for f in features]
    got = df.agg(*(m.alias(f"m{i}") for i, m in enumerate(means))).first()
    if got["m0"] is None:
        return [0.0] * k, 0
    gram, h = np.zeros((k, k)), np.array(got[len(upper):], float)
    for (i, j), value in zip(upper, got, strict=False):
        gram[i, j] = gram[j, i] = value
    w, steps = np.zeros(k), 0
    for steps in range(1, iterations + 1):
        s = step / math.sqrt(steps)
        new = w * (1.0 - s * reg) - s * (gram @ w - h)
        done = steps >= 2 and np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1.0)
        w = new
        if done:
            break
    return w.tolist(), steps


def text_classifier(train: DataFrame, text: str, label: str, num_features: int = 1 << 16,
                    max_iter: int = 50, reg: float = 0.01):
    """ML1: tokenize -> hashed term frequencies -> IDF -> logistic regression.

    The training texts are tokenized once: their term-frequency vectors are
    persisted and feed both the IDF fit and the regression (a plain
    ``Pipeline.fit`` would tokenize the corpus again for the second). The
    result is the same ``PipelineModel`` a pipeline fit returns.
    """
    tok = Tokenizer(inputCol=text, outputCol="_tokens")
    htf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    tf = htf.transform(tok.transform(train)).select("_tf", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf = IDF(inputCol="_tf", outputCol="features").fit(tf)
        lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg)
        model = lr.fit(idf.transform(tf))
    finally:
        tf.unpersist()
    return PipelineModel(stages=[tok, htf, idf, model])
