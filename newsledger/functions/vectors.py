"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsledger import schema as S


def constant_vector(dim: int = S.EMBEDDING_DIM) -> Column:
    """The stand-in for a missing vector: small, constant and not zero, so that its cosine exists."""
    return F.array_repeat(F.lit(S.SAFE_VECTOR_VALUE).cast("float"), dim)


def is_usable(vector: Column, dim: int = S.EMBEDDING_DIM) -> Column:
    """Right size, no null, NaN or infinite element, not all zero."""
    # Least and greatest element instead of a function per element: NaN counts as greatest, a search gives null where elements are null.
    least, most, inf = F.array_min(vector), F.array_max(vector), F.lit(float("inf")).cast("float")
    finite = ~F.coalesce(F.array_contains(vector, inf), F.lit(True)) & (least > -inf) & (most < inf)
    return F.coalesce((F.size(vector) == dim) & finite & ((least != 0) | (most != 0)), F.lit(False))


def safe_vector(vector: Column, dim: int = S.EMBEDDING_DIM) -> Column:
    """``vector`` where usable, else the constant vector."""
    return F.when(is_usable(vector, dim), vector).otherwise(constant_vector(dim))
