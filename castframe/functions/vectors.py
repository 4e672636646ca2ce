"""Vector maths: as built-in higher-order functions and as NumPy kernels.

The higher-order functions run inside the JVM but are interpreted, element by
element; the kernels work on whole Arrow batches and are the faster route for
scoring many vectors against a gallery. Both give the same scores: cosine
similarity in double precision, rounded to ``SCORE_DECIMALS`` places so that
copies of one vector score equal whatever batch they come in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from castframe.schema import NORM_GUARD

SCORE_DECIMALS = 12


def as_float_vector(vector: Column) -> Column:
    return vector.cast("array<float>")


def is_finite_vector(vector: Column) -> Column:
    """Whether there is a vector, it has elements, and all of them are finite numbers."""
    known = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & known, F.lit(False))


def l2_norm(vector: Column) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def scaled(vector: Column, norm: Column) -> Column:
    """The vector divided by its guarded norm.

    Pass the norm as a column that stays in the output; otherwise Catalyst
    folds it into the lambda and computes it once per element.
    """
    return F.transform(vector, lambda x: x.cast("double") / (norm + NORM_GUARD))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity of two columns; vectors of unequal length fail the job."""
    checked = F.when(
        F.size(left) == F.size(right),
        dot(left, right) / ((l2_norm(left) + NORM_GUARD) * (l2_norm(right) + NORM_GUARD)),
    ).otherwise(F.raise_error(F.lit("vectors differ in length")).cast("double"))
    return F.round(checked, SCORE_DECIMALS)


def stack(vectors: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """An Arrow list column as one float64 matrix of ``dims`` columns."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (vectors.null_count or not np.all(lengths == dims)):
        raise ValueError(f"every vector must have {dims} elements")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / (np.linalg.norm(matrix, axis=1, keepdims=True) + NORM_GUARD)


def cosine_matrix(left: np.ndarray, right_unit: np.ndarray) -> np.ndarray:
    """Scores of every row of ``left`` against already normalised rows."""
    return np.round(unit_rows(left) @ right_unit.T, SCORE_DECIMALS)
