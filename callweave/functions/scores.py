"""Scores and flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal_score(text: Column, ranks: list[str]) -> Column:
    """Worst to best wording as 20, 40, ... 100 for five ranks; unknown wording is null."""
    step = 100 // len(ranks)
    out = F.when(F.lower(text) == ranks[0].lower(), step)
    for i, rank in enumerate(ranks[1:], start=2):
        out = out.when(F.lower(text) == rank.lower(), i * step)
    return out


def mapped(text: Column, values: Mapping[str, int]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.try_element_at(pairs, text)


def yes_flag(text: Column) -> Column:
    return F.when(F.lower(text) == "yes", 1).otherwise(0)
