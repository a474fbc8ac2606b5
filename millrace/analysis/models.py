"""MLlib models with the settings the toolkit uses, and small helpers around them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import contiguous_folds
from ..session import cut
from ..functions import arrays
from ..functions.stopwords import ENGLISH


#: The deepest tree that MLlib grows, and the thresholds that a continuous feature gets from the rows.
MAX_DEPTH, BINS = 30, 256
#: Buckets of hashed terms.
TERM_BUCKETS = 1 << 15


def assembled(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def from_array(df: DataFrame, array: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(arrays.doubles(F.col(array))))


def logistic(rows: int, label: str = "label", **settings) -> LogisticRegression:
    """L2 penalty of strength 1 spread over the rows, features as they are."""
    return LogisticRegression(labelCol=label, regParam=1.0 / max(rows, 1), standardization=False, **settings)


def decision_tree(depth: int = MAX_DEPTH, leaf: int = 1, label: str = "label", bins: int = BINS) -> DecisionTreeClassifier:
    """Splits by entropy. A feature has at most ``bins`` - 1 thresholds: all of them if it has fewer values."""
    return DecisionTreeClassifier(
        labelCol=label, impurity="entropy", maxDepth=depth, minInstancesPerNode=leaf, maxBins=bins, seed=1
    )


def random_forest(
    trees: int = 21, per_split: str = "1", label: str = "label", depth: int = MAX_DEPTH, bins: int = BINS
) -> RandomForestClassifier:
    """Splits by Gini impurity, grown to ``depth``."""
    return RandomForestClassifier(
        labelCol=label, impurity="gini", numTrees=trees, featureSubsetStrategy=per_split, maxDepth=depth, maxBins=bins, seed=1
    )


def linear(label: str = "label") -> LinearRegression:
    return LinearRegression(labelCol=label, solver="normal")


def perceptron(layers: Sequence[int], label: str = "label") -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), maxIter=100, seed=1)


def accuracy(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    hits = (F.col("prediction") == F.col(label)).cast("double")
    return model.transform(df).agg(F.count("*").alias("rows"), F.avg(hits).alias("accuracy"))


def kmeans_elbow(df: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean distance to the nearest centre for each k. One centre is the mean itself."""
    rows = cut(df.select("features"))
    found = []
    for k in ks:
        if k == 1:
            size = len(rows.select(vector_to_array("features").alias("v")).first()["v"])
            mean = rows.select(F.posexplode(vector_to_array("features")).alias("at", "x")).groupBy("at").agg(F.avg("x").alias("m")).collect()
            by_place = {r["at"]: r["m"] for r in mean}
            centres = [[by_place[i] for i in range(size)]]
        else:
            centres = [list(map(float, c)) for c in KMeans(k=k, seed=1).fit(rows).clusterCenters()]
        vector = vector_to_array("features")
        nearest = F.least(*[arrays.euclidean(vector, _literal(c)) for c in centres]) if len(centres) > 1 else arrays.euclidean(vector, _literal(centres[0]))
        found.append(rows.agg(F.avg(nearest).alias("mean_distance")).select(F.lit(k).alias("k"), "mean_distance"))
    first, *rest = found
    for part in rest:
        first = first.unionByName(part)
    return first


def _literal(values: Sequence[float]):
    return F.array(*[F.lit(float(v)) for v in values])


def kmeans_groups(df: DataFrame, k: int) -> DataFrame:
    return KMeans(k=k, seed=1, predictionCol="cluster").fit(df).transform(df)


def bisecting_groups(df: DataFrame, k: int) -> DataFrame:
    return BisectingKMeans(k=k, seed=1, predictionCol="cluster").fit(df).transform(df)


def project(df: DataFrame, columns: Sequence[str], vectors: np.ndarray, k: int) -> DataFrame:
    """Scores of the first ``k`` components; columns are centred first."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    scores = {
        f"pc_{j + 1}": sum((F.col(c) - F.lit(means[c])) * F.lit(float(vectors[i, j])) for i, c in enumerate(columns))
        for j in range(k)
    }
    return df.withColumns(scores)


def fold_scores(df: DataFrame, order: Sequence[str], folds: int, estimator) -> DataFrame:
    """Accuracy of each contiguous fold by a model of the others."""
    parts = cut(contiguous_folds(df, order, folds))
    found = []
    for fold in range(1, folds + 1):
        model = estimator.fit(parts.filter(F.col("fold") != fold))
        found.append(accuracy(model, parts.filter(F.col("fold") == fold)).withColumn("fold", F.lit(fold)))
    first, *rest = found
    for part in rest:
        first = first.unionByName(part)
    return first


def converged(model, most: int):
    """``model``, if its fit ended by tolerance before ``most`` iterations; raises otherwise."""
    if model.summary.totalIterations >= most:
        raise ValueError(f"no convergence within {most} iterations")
    return model


def term_vectors(df: DataFrame, text: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Counts of hashed words and word pairs as sparse vectors.

    Terms are hashed, so no vocabulary has to pass through the driver; terms of one bucket share a place.
    """
    words = RegexTokenizer(inputCol=text, outputCol="_raw", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False)
    kept = StopWordsRemover(inputCol="_raw", outputCol="_words", stopWords=list(ENGLISH))
    pairs = NGram(n=2, inputCol="_words", outputCol="_pairs")

    split = pairs.transform(kept.transform(words.transform(df)))
    terms = split.withColumn("_terms", F.concat("_words", "_pairs")).drop("_raw", "_words", "_pairs")
    return HashingTF(inputCol="_terms", outputCol="features", numFeatures=buckets).transform(terms).drop("_terms")
