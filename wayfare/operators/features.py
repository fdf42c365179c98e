"""Feature blocks: one-hot, scaling, reduction and weighted combination."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF, PCA, ElementwiseProduct, HashingTF, Normalizer, OneHotEncoder, StandardScaler, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weight of each block in the combined vector.
BLOCK_WEIGHTS = {"reduced": 0.5, "category": 0.2, "rating": 0.15, "location": 0.1, "sentiment": 0.05}
CATEGORICAL = {
    "category": ("primary_category",), "location": ("city", "state", "country"), "sentiment": ("sentiment",),
    "tiers": ("rating_tier", "popularity_tier"),
}


def mean_vector(df: DataFrame, keys: Sequence[str], vector: str, out: str) -> DataFrame:
    """Mean vector per group; partial sums are built in each task."""
    return df.groupBy(*keys).agg(Summarizer.mean(array_to_vector(F.col(vector))).alias("_m")).select(
        *keys, vector_to_array("_m").alias(out))


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The ones of the one-hot matrix: (key, feature)."""
    features = F.array(*[F.concat_ws("_", F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN"))) for c in columns])
    return df.select(key, F.explode(features).alias("feature"))


def standardized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to mean 0 and population standard deviation 1; a constant column becomes 0."""
    statistics = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]).alias("s")).scalar()
    scaled = df.withColumn("_s", statistics)
    for c in columns:
        centred = F.col(c) - F.col(f"_s.{c}.mean")
        scaled = scaled.withColumn(c, F.when(F.col(f"_s.{c}.std") == 0, F.lit(0.0)).otherwise(centred / F.nullif(F.col(f"_s.{c}.std"), F.lit(0.0))))
    return scaled.drop("_s")


def project(df: DataFrame, vector: str, dim: int, width: int, seed: int = 42) -> DataFrame:
    """Gaussian random projection to ``width`` numbers; the matrix is drawn from the seed in each task.

    A step of its own for callers whose vectors are so wide that the covariance
    matrix of ``reduce_vectors`` (width squared numbers, on the driver) is too
    much; it changes the numbers, so nothing here takes it unasked.
    """
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def projected(vectors: pd.Series) -> pd.Series:
        basis = np.random.default_rng(seed).standard_normal((dim, width)) / np.sqrt(width)
        return pd.Series(list(np.stack(vectors.to_numpy()).astype(np.float64) @ basis)) if len(vectors) else pd.Series([], dtype=object)

    return df.withColumn(vector, projected(F.col(vector)))


def reduce_vectors(df: DataFrame, vector: str, dim: int, width: int, out: str = "reduced") -> DataFrame:
    """Standardised, length-normalised vectors reduced to ``width`` principal components; the same way at every width."""
    stages = [
        StandardScaler(inputCol="_in", outputCol="_scaled", withMean=True, withStd=True),
        Normalizer(inputCol="_scaled", outputCol="_unit", p=2.0),
        PCA(k=min(width, dim), inputCol="_unit", outputCol=out),
    ]
    prepared = df.withColumn("_in", array_to_vector(F.col(vector).cast("array<double>")))
    return Pipeline(stages=stages).fit(prepared).transform(prepared).drop("_in", "_scaled", "_unit")


def encode(df: DataFrame) -> DataFrame:
    """Vector columns ``category_block``, ``location_block``, ``sentiment_block`` and ``rating_block``."""
    filled = df.na.fill({"city": "UNKNOWN", "state": "UNKNOWN", "country": "UNKNOWN", "rating": 0, "weighted_rating": 0.0})
    for c in (name for names in CATEGORICAL.values() for name in names):
        filled = filled.withColumn(c, F.col(c).cast("string"))
    names = [name for group in CATEGORICAL.values() for name in group]
    stages = [
        StringIndexer(inputCols=names, outputCols=[f"{n}_i" for n in names], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{n}_i" for n in names], outputCols=[f"{n}_v" for n in names], dropLast=True),
    ]
    for block in ("category", "location", "sentiment"):
        stages.append(VectorAssembler(inputCols=[f"{n}_v" for n in CATEGORICAL[block]], outputCol=f"{block}_block"))
    stages.append(VectorAssembler(
        inputCols=["rating", "weighted_rating", "rating_tier_v", "popularity_tier_v"], outputCol="rating_block"))
    encoded = Pipeline(stages=stages).fit(filled).transform(filled)
    return encoded.drop(*[f"{n}_i" for n in names], *[f"{n}_v" for n in names])


def combine(df: DataFrame, weights: dict[str, float] = BLOCK_WEIGHTS) -> DataFrame:
    """Standardise the blocks (population deviation), weigh them and join them to ``features``."""
    blocks = ("category", "rating", "location", "sentiment")
    n = df.count()
    # Spark scales by the sample deviation; this factor turns it into the population's.
    to_population = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    stages = [StandardScaler(inputCol=f"{b}_block", outputCol=f"_{b}", withMean=True, withStd=True) for b in blocks]
    scaled = Pipeline(stages=stages).fit(df).transform(df)

    def weighed(column: str, factor: float):
        return F.transform(vector_to_array(column), lambda x: x * F.lit(factor))

    parts = [weighed("reduced", weights["reduced"])] + [weighed(f"_{b}", weights[b] * to_population) for b in blocks]
    return scaled.withColumn("features", F.concat(*parts)).drop(*[f"_{b}" for b in blocks])


def combine_sparse(df: DataFrame, weights: dict[str, float] = BLOCK_WEIGHTS) -> DataFrame:
    """``combine`` without taking the means away, which moves no distance: ``features`` is a vector in which one-hot blocks stay sparse."""
    blocks = ("category", "rating", "location", "sentiment")
    n = df.count()
    to_population = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    scalers = [StandardScaler(inputCol=f"{b}_block", outputCol=f"_{b}", withMean=False, withStd=True).fit(df) for b in blocks]
    scaled = df
    for scaler in scalers:
        scaled = scaler.transform(scaled)
    joined = VectorAssembler(inputCols=["reduced", *[f"_{b}" for b in blocks]], outputCol="_joined")
    factors = [weights[b] * to_population for b, scaler in zip(blocks, scalers) for _ in range(scaler.std.size)]
    joined = joined.transform(scaled)
    width = joined.schema["_joined"].metadata["ml_attr"]["num_attrs"] - len(factors)
    weighed = ElementwiseProduct(scalingVec=Vectors.dense([weights["reduced"]] * width + factors), inputCol="_joined", outputCol="features")
    return weighed.transform(joined).drop("_joined", *[f"_{b}" for b in blocks])


def hashed_tfidf(df: DataFrame, text: str, width: int = 1 << 16, out: str = "features") -> DataFrame:
    """Unit-length TF-IDF over hashed words: the deterministic stand-in for an embedding model."""
    stages = [
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=width),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol=out, p=2.0),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("_words", "_tf", "_tfidf")
