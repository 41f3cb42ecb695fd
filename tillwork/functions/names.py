"""Column-name clean-up. Each helper is one projection, however many columns change."""

from __future__ import annotations

from pyspark.sql import DataFrame

QUOTES = "'\""


def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case every name and remove all quote characters in it."""
    drop_quotes = str.maketrans("", "", QUOTES)
    return df.toDF(*[name.translate(drop_quotes).lower() for name in df.columns])


def trim_names(df: DataFrame, quotes: str = QUOTES, lower: bool = True) -> DataFrame:
    """Strip quote characters at the ends of names only; inner quotes and blanks stay."""
    names = [name.strip(quotes) for name in df.columns]
    return df.toDF(*[name.lower() if lower else name for name in names])


def quoted(name: str) -> str:
    """``name`` as one back-ticked identifier part."""
    return "`" + name.replace("`", "``") + "`"
