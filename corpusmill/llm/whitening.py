"""Embedding whitening: the singular values of the centred rows by MLlib, exact sums for all that can be exact.

Entries become whole numbers, x = floor(64 c) + 1000000; sums by dimension and the deviations (n x - S)^2 are exact. Rows are centred
before they are multiplied: (n x - S) / n is one rounding of a whole number. ``RowMatrix.computeSVD`` of the centred rows gives
the components; singular values s become eigenvalues s^2 / n, as MLlib doesn't divide. It is asked for so many components that it
decomposes the Gramian by LAPACK on the driver (dimensions squared, whatever the number of rows) instead of iterating to a
tolerance. The total variance is the sum of the exact deviations over n^3, apart from the decomposition.

Four passes read the whole numbers, each a map with partial sums; the model (sums, components) is as large as the dimensions.

Edge cases
    Null vectors and vectors with null, NaN or infinite entries are dropped, as are vectors whose length isn't the commonest (of
    equally common ones the longest): they have no covariance with the others. A null vec_id is kept, rows that repeat one each
    get theirs. Components whose eigenvalue is below ``LEAST`` of the largest (dimensions that depend on others, one row, equal
    rows) can't be told from rounding and have no rows. An empty table gives an empty result. Entries must be so that n (64 c +
    1000000) fits in 64 bits; a deviation that doesn't fit in 38 digits is an error. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, ship

ship(__name__)

#: Whole numbers of an entry's unit, and what is added to make them positive.
STEPS, SHIFT = 64, 1_000_000
#: Smallest eigenvalue, as a part of the largest, that double precision can tell from nothing.
LEAST = 1e-12


class Model(NamedTuple):
    n: int
    sums: np.ndarray  # int64, by dimension
    components: np.ndarray  # dimensions x components
    values: np.ndarray  # eigenvalues, falling


def whole_numbers(df: DataFrame, vectors: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, x: the usable vectors as arrays of whole numbers; those of the commonest length."""
    double = F.transform(F.col(vectors), lambda c: c.cast("double"))
    sound = F.forall(double, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    usable = df.filter(F.col(vectors).isNotNull()).filter(sound)
    x = materialise(usable.select(F.col(key).alias("vec_id"), F.transform(double, lambda c: F.floor(c * STEPS).cast("long") + SHIFT).alias("x")))
    length = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return x.filter(F.size("x") == (length.d if length else 0))


def _row_matrix(rows: Column, df: DataFrame) -> RowMatrix:
    return RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(rows).alias("v")), "v"))


def fit(x: DataFrame, most: int = 32) -> Model:
    """The model of a frame of x."""
    found = x.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.count("value").alias("n"), F.sum("value").alias("s")).orderBy("at").collect()
    n, sums, d = (found[0].n if found else 0), [r.s for r in found], len(found)
    none = Model(n, np.array(sums, np.int64), np.zeros((d, 0)), np.zeros(0))
    if n < 2:
        return none
    centred = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda v, s: (v * n - s).cast("double") / n)
    # more than half of the dimensions: MLlib then takes LAPACK on the Gramian
    svd = _row_matrix(centred, x).computeSVD(min(d, max(most, d // 2 + 1)), computeU=False, rCond=LEAST**0.5)
    values = svd.s.toArray() ** 2 / n
    keep = np.flatnonzero((values > 0) & (values >= LEAST * values.max(initial=0)))[:most]
    components = svd.V.toArray()[:, keep]
    # the same sign in every run: the largest entry is positive
    components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(keep))]) if len(keep) else components
    return none._replace(components=components, values=values[keep])


def project(x: DataFrame, model: Model) -> DataFrame:
    """vec_id, deviation (decimal), w (array of whitened components)."""
    n, sums, weights = model.n, model.sums, model.components / np.sqrt(model.values)
    vec_id = x.schema["vec_id"].dataType.simpleString()

    def whiten(batches):
        for b in batches:
            if not b.num_rows:
                continue
            off = b.column("x").flatten().to_numpy().reshape(b.num_rows, len(sums)) * n - sums
            if float(np.abs(off).max()) ** 2 * len(sums) < 2**62:
                deviation = pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:  # beyond 64 bits
                deviation = pa.array([Decimal(sum(v * v for v in row)) for row in off.tolist()], pa.decimal128(38, 0))
            w = (off.astype(np.float64) / n) @ weights
            w = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), deviation, w], names=["vec_id", "deviation", "w"])

    return map_arrow(x.select("vec_id", "x"), whiten, f"vec_id {vec_id}, deviation decimal(38,0), w array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest entry of the covariance of w, centred, less the identity."""
    means = dict(whitened.select(F.posexplode("w").alias("at", "value")).groupBy("at").agg(F.avg("value")).collect())
    centred = F.zip_with("w", F.array(*[F.lit(means[i]) for i in range(k)]), lambda v, m: v - m)
    return float(np.abs(_row_matrix(centred, whitened).computeGramianMatrix().toArray() / n - np.eye(k)).max())


def whiten(df: DataFrame, vectors: str = "embedding", key: str = "vec_id", most: int = 32) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    x = whole_numbers(df, vectors, key)
    model = fit(x, most)
    k = len(model.values)
    columns = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not k:
        return df.select(F.col(key).alias("vec_id")).filter("false").selectExpr("vec_id", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in columns.split(", ")])
    rows = materialise(project(x, model))
    total = Fraction(int(rows.agg(F.sum("deviation")).first()[0]), model.n**3)
    explained = [float(Fraction(float(e)) / total) for e in model.values]
    error = identity_error(rows, model.n, k)
    flat = rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return flat.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(F.array(*[F.lit(v) for v in explained]), F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
