"""Principal components of a vector column, for charts."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def principal_components(df: DataFrame, vector: str = "vector", k: int = 3, out: str = "components") -> DataFrame:
    """Add the first k components of the centred vectors (fits on the whole table: an action).

    Only the covariance of the dimensions leaves the executors. Each axis points so that its largest loading is
    positive.
    """
    dense = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(dense).transform(dense)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    raw = vector_to_array("_p")
    signed = F.array(*[raw[i] * F.lit(float(s)) for i, s in enumerate(signs)])
    return model.transform(centred).withColumn(out, signed).drop("_v", "_c", "_p")
