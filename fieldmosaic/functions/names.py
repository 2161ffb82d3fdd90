"""Keys and column names in one spelling."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def species_key(name: Column) -> Column:
    """Trimmed, lower case, every space an underscore (all of them, so that trinomials are whole)."""
    return F.lower(F.replace(F.trim(name), F.lit(" "), F.lit("_")))


def normal_name(name: str, mode: str = "simple") -> str:
    """simple: spaces to underscores; strict: every run of other characters than a-z and 0-9 is one underscore."""
    name = name.strip().lower()
    return name.replace(" ", "_") if mode == "simple" else re.sub(r"[^a-z0-9]+", "_", name)


def normalize_columns(df: DataFrame, mode: str = "simple") -> DataFrame:
    names = [normal_name(c, mode) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would share a name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, names: list[str], strict: bool = True) -> DataFrame:
    """Without the named columns; strict: every one of them must be there."""
    if strict and (missing := [n for n in names if n not in df.columns]):
        raise KeyError(f"no such columns: {missing}")
    return df.drop(*names)
