"""Joins against a table with unique keys when few keys hold many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is hot; there are at most 1 / SHARE of them.
SHARE = 0.02


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Every value of ``key`` that holds more than ``share`` of the rows (and maybe some that don't).

    Counts with a bounded sketch in one pass, so at most ``1 / share`` values come back.
    """
    found = df.select(key).where(F.col(key).isNotNull()).stat.freqItems([key], share).first()
    return list(found[0] or []) if found else []


def join_unique(left: DataFrame, right: DataFrame, key: str, hot: list | None = None) -> DataFrame:
    """Left join with ``right``, which has each ``key`` once.

    Rows of hot keys meet a broadcast of the at most ``1 / SHARE`` rows of
    ``right`` that have those keys; all others are joined by shuffle. Null
    keys stay and match nothing.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, "left")
    many = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = F.broadcast(right.where(F.col(key).isin(hot)))
    return left.where(~many).join(right, key, "left").unionByName(left.where(many).join(few, key, "left"))
