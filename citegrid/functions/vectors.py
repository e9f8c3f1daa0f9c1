"""Dense-vector column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citegrid.functions.text import col


def as_float_vector(v: Column | str) -> Column:
    """The stored vector type, ``array<float>``."""
    return col(v).cast("array<float>")


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(v).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))


def l2_normalize(v: Column | str) -> Column:
    """Divide by the Euclidean norm; a zero vector gives nulls instead of
    failing the job (ANSI division by zero)."""
    n = l2_norm(v)
    return F.transform(col(v).cast("array<double>"), lambda x: F.try_divide(x, n))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two equal-length vectors (row-wise, for checks)."""
    return F.aggregate(F.zip_with(col(a).cast("array<double>"), col(b).cast("array<double>"),
                                  lambda x, y: x * y), F.lit(0.0), lambda s, p: s + p)


def encoder_udf(make_predict_fn, dim: int, batch_size: int = 256):
    """P2 encoder slot: ``make_predict_fn()`` returns a function from a NumPy
    array of strings to an (n, dim) float array; it is called once per Python
    worker and fed Arrow batches (``predict_batch_udf``).  Output vectors are
    L2-normalised afterwards with ``l2_normalize``."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType
    return predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()), batch_size=batch_size,
                             input_tensor_shapes=None)
