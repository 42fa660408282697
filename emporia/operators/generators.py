"""Row generators: keyword arrays, delimited lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Characters up to the space, as the source's trim takes off both ends.
WHITE_SPACE = "".join(map(chr, range(33)))


def explode_keywords(df: DataFrame, col: str = "keywords", out: str = "keyword") -> DataFrame:
    """G1: one row per trimmed, non-empty array element; null/empty array -> no row."""
    return (
        df.withColumn(out, F.explode(F.col(col)))
        .withColumn(out, F.btrim(F.col(out), F.lit(WHITE_SPACE)))
        .filter(F.length(F.col(out)) > 0)
    )


def explode_split(df: DataFrame, col: str, sep: str = ",", out: str = "item", pos: str = "pos") -> DataFrame:
    """``LATERAL VIEW explode_split(col, sep)`` keeping the position.

    ``split`` takes a pattern, so the separator is escaped; an empty string
    yields one empty item and a null yields no row, like the SQL form.
    """
    return df.select("*", F.posexplode(F.split(F.col(col), re.escape(sep))).alias(pos, out))
