"""How expressions are evaluated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, each made once as a whole.

    A filter put on a computed column is otherwise moved below its projection, where the arrays it
    is made from are computed anew for every element of a higher-order function.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode(F.array(whole)).alias("row")).select("row.*")
