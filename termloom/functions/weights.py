"""Term weights. tf and idf are single-precision values widened to double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

IDF_MODES = ("default", "classic")


def _as_float(value: Column) -> Column:
    return value.cast("float").cast("double")


def tf(freq: Column) -> Column:
    return _as_float(F.sqrt(freq.cast("double")))


def idf(df: Column, n_docs: Column, mode: str = "default") -> Column:
    """``default`` grows with df: ln((df+1)/(N+1))+1. ``classic`` is its usual inverse."""
    if mode not in IDF_MODES:
        raise ValueError(f"idf mode must be one of {IDF_MODES}, not {mode!r}")
    top, bottom = (df, n_docs) if mode == "default" else (n_docs, df)
    ratio = (top + 1).cast("double") / (bottom + 1).cast("double")
    return _as_float(F.ln(ratio) + F.lit(1.0))
