"""Ordered row rules: the first broken rule names the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    reason: str
    broken: Column


def first_reason(rules: Sequence[Rule]) -> Column:
    """NULL for a row that breaks no rule. A rule that evaluates to NULL counts as kept."""
    if not rules:
        return F.lit(None).cast("string")
    first, *rest = rules
    reason = F.when(first.broken, F.lit(first.reason))
    for rule in rest:
        reason = reason.when(rule.broken, F.lit(rule.reason))
    return reason


def validate(df: DataFrame, rules: Sequence[Rule], into: str = "validation_reason") -> DataFrame:
    return df.withColumn(into, first_reason(rules))


def accepted(df: DataFrame, reason: str = "validation_reason") -> DataFrame:
    return df.where(F.col(reason).isNull())


def rejected(df: DataFrame, reason: str = "validation_reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull())
