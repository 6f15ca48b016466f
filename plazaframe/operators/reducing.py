"""Sampling and principal components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, fraction: float | None, seed: int = 42) -> DataFrame:
    """A random share of the rows; all of them for no fraction or one of at least 1."""
    if fraction is None or fraction >= 1.0:
        return df
    return df.sample(False, float(fraction), seed)


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """A share of the keys, the same ones whatever the partitioning, run or engine.

    A key is taken if the first 32 bits of the MD5 of its text fall below the fraction.
    """
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.filter(head < F.lit(int(fraction * 2**32)))


def principal_components(df: DataFrame, columns: Sequence[str], k: int, out: str = "components") -> DataFrame:
    """Add an array with the row's first ``k`` principal components.

    ``columns`` are numbers, or one array of numbers.  What is gathered is a matrix whose size
    depends on the number of columns, not on the rows.
    """
    if df.schema[columns[0]].dataType.typeName() == "array":
        ready = df.withColumn("_features", array_to_vector(F.col(columns[0]).cast("array<double>")))
        stages = []
    else:
        ready = df
        stages = [VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="keep")]
    fitted = Pipeline(stages=[*stages, PCA(k=k, inputCol="_features", outputCol="_pca")]).fit(ready)
    return fitted.transform(ready).withColumn(out, vector_to_array("_pca")).drop("_features", "_pca")
