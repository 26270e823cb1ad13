"""Model jobs re-aimed at tables.

The neural nets are out of scope; what remains are Spark ML pipelines
(fit once on the training split, transform the rest) and batch scoring of
the tokens of packed rows with an injected scorer on pandas frames.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import (CountVectorizer, Imputer, MinMaxScaler, OneHotEncoder, RegexTokenizer,
                                StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import in_slices


def tabular_mlp(train: DataFrame, test: DataFrame, label: str, numeric, categorical,
                hidden: int = 3, seed: int = 42, max_iter: int = 200) -> DataFrame:
    """Impute -> index -> one-hot -> assemble -> min-max -> MLP([d, hidden, 2])."""
    imputed = [f"{c}_imp" for c in numeric]
    idx = [f"{c}_idx" for c in categorical]
    ohe = [f"{c}_ohe" for c in categorical]
    stages = [Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean"),
              StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                            stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=False, handleInvalid="keep"),
              VectorAssembler(inputCols=imputed + ohe, outputCol="raw"),
              MinMaxScaler(inputCol="raw", outputCol="features")]
    prep = Pipeline(stages=stages).fit(train)
    d = len(prep.transform(train.limit(1)).first()["features"])
    mlp = MultilayerPerceptronClassifier(layers=[d, hidden, 2], labelCol=label, seed=seed, maxIter=max_iter)
    return mlp.fit(prep.transform(train)).transform(prep.transform(test))


def text_classifier(train: DataFrame, test: DataFrame, text: str, label: str, vocab: int = 5000,
                    max_iter: int = 30) -> DataFrame:
    """Bag of words over the top-``vocab`` terms + multinomial logistic
    regression (word order is given up, unlike the sequence nets)."""
    stages = [RegexTokenizer(inputCol=text, outputCol="words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
              StopWordsRemover(inputCol="words", outputCol="kept"),
              CountVectorizer(inputCol="kept", outputCol="features", vocabSize=vocab),
              LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, family="multinomial")]
    return Pipeline(stages=stages).fit(train).transform(test)


def cross_validated(rows: DataFrame, fold: str, fit: Callable[[DataFrame], object],
                    score: Callable[[object, DataFrame], DataFrame], folds, train: DataFrame | None = None,
                    at_a_time: int = 4) -> DataFrame:
    """Out-of-fold scores of all rows: for each of ``folds`` a model is fitted
    on the rows of the other folds and scores the rows of this one.

    ``fit`` takes the training rows, ``score`` the model and the rows left out.
    ``train`` may give other training rows than those scored, such as counts of
    equal rows with a weight; it needs the column ``fold`` too.  The fits are
    independent jobs, ``at_a_time`` of which are submitted side by side.  Rows
    of a null fold are in no fold: they train every model and are not scored.
    ``model_folds`` lists the folds that taught a row's model.
    """
    train = rows if train is None else train
    folds = list(folds)

    def one(k):
        rest = train.filter(~F.col(fold).eqNullSafe(F.lit(k)))
        out = score(fit(rest), rows.filter(F.col(fold) == k))
        return out.withColumn("model_folds", F.array(*[F.lit(x) for x in folds if x != k]).cast("array<bigint>"))

    with ThreadPoolExecutor(at_a_time) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, folds))


def naive_bayes(train: DataFrame, features, label: str = "label", weight: str = "n") -> NaiveBayesModel:
    """Bernoulli naive Bayes (smoothing 1) on 0/1 columns of weighted rows."""
    d = VectorAssembler(inputCols=list(features), outputCol="_x").transform(train)
    return NaiveBayes(modelType="bernoulli", smoothing=1.0, featuresCol="_x", labelCol=label, weightCol=weight).fit(d)


def positive_share(model, rows: DataFrame, features, name: str = "prob") -> DataFrame:
    """``rows`` with the model's probability of label 1."""
    d = VectorAssembler(inputCols=list(features), outputCol="_x").transform(rows)
    out = model.setFeaturesCol("_x").setProbabilityCol("_p").setRawPredictionCol("_r").setPredictionCol("_y").transform(d)
    return out.withColumn(name, F.get(vector_to_array("_p"), F.lit(1))).drop("_x", "_p", "_r", "_y")


def length_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Deterministic stand-in scorer: sigmoid(token length - 5)."""
    out = pdf[["pn_num", "feature_num", "tok_no", "s", "e"]].copy()
    out["prob"] = 1.0 / (1.0 + np.exp(-((out["e"] - out["s"]).astype("float64") - 5.0)))
    return out


def batch_score(rows: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame] = length_scorer, keys=("pn_num", "feature_num"),
                name: str = "probs") -> DataFrame:
    """``rows`` with ``name``: the scores of their tokens, in the order of the arrays ``s`` and ``e``.

    A map without a shuffle.  ``scorer`` takes a frame (keys, tok_no, s, e) of
    tokens, those of many rows at a time, and returns it with ``prob``; neither
    the keys nor the offsets of a token cross to Python more than once a row."""
    keys = list(keys)

    def frame(s, e, *ids):
        null = s.is_null()
        s, e = s.fill_null([]), e.fill_null([])
        off = s.offsets.to_numpy() - s.offsets[0].as_py()
        size = np.diff(off)
        tokens = pd.DataFrame({k: np.repeat(x.to_numpy(zero_copy_only=False), size) for k, x in zip(keys, ids)})
        tokens["tok_no"] = (np.arange(1, off[-1] + 1) - np.repeat(off[:-1], size)).astype(np.int32)
        tokens["s"], tokens["e"] = s.flatten().to_numpy(), e.flatten().to_numpy()
        prob = scorer(tokens)["prob"].to_numpy(dtype="float64")
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(prob), mask=null)

    @F.arrow_udf("array<double>")
    def scores(s: pa.Array, e: pa.Array, *ids: pa.Array) -> pa.Array:
        return in_slices(frame, s, e, *ids)

    return rows.withColumn(name, scores("s", "e", *keys))
