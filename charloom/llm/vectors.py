"""Clean vectors: one row per key, whatever their lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, vec)`` of the vectors that take part, in double precision.

    NULL, empty and zero vectors, vectors with NULL or non-finite components, and rows without a key take no part. Of a
    key that repeats with several vectors the smallest counts.
    """
    size = F.size(vector)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = df.where(
        F.col(key).isNotNull()
        & F.col(vector).isNotNull()
        & (size > 0)
        & F.coalesce(finite, F.lit(False))
        & F.exists(vector, lambda x: x != 0)
    ).select(F.col(key).alias("key"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("vec"))
    return clean.groupBy("key").agg(F.min("vec").alias("vec"))


def by_length(clean: DataFrame) -> list[DataFrame]:
    """``clean`` as one table per vector length, for only vectors of one length can be compared.

    Each length is a search of its own, so a table of very many lengths is as many searches.
    """
    lengths = sorted(r["n"] for r in clean.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1))).collect())
    return [clean.where(F.size("vec") == n) for n in lengths]
