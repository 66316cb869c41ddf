"""User-supplied Python functions as columns, evaluated on Arrow batches.

The only place for row logic that built-in functions cannot express; prefer a ``Column -> Column`` function
wherever one exists.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType


def detector_from(predicate: Callable[[str], bool]) -> Callable[[Column], Column]:
    """A detector for ``split_counts`` and ``write_language_split`` from a function of one text."""

    def batch(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else bool(predicate(t))).astype("boolean")

    return F.pandas_udf(batch, BooleanType())


def tokenize_batches(
    df: DataFrame,
    tokenize: Callable[[Sequence[str]], Sequence[Sequence[int]]],
    text: str = "text",
    max_len: int = 2048,
    floor: int = 256,
) -> DataFrame:
    """Replace the text column by ``tokens`` from a function over a batch of texts, clipped in length."""
    limit = max(floor, max_len)

    def batch(texts: pd.Series) -> pd.Series:
        rows = tokenize([t or "" for t in texts])
        return pd.Series([list(r)[:limit] for r in rows], index=texts.index)

    tokens = F.pandas_udf(batch, ArrayType(IntegerType()))
    return df.withColumn("tokens", tokens(F.col(text))).drop(text)
