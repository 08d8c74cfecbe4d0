"""Split rows into valid and rejected by an ordered list of rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "REJECTION_REASON"
_BAD = "__bad"


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for a violation, and NULL where the rule cannot tell; ``message`` says why."""

    name: str
    bad: Column
    message: Column


def judge(df: DataFrame, rules: list[Rule], strict: bool = False) -> DataFrame:
    """Add the verdict (true, false or NULL) and the message of the first rule that is violated.

    By default NULL follows SQL: a row on which no rule is violated but one cannot tell belongs to
    neither side. ``strict`` counts "cannot tell" as a violation, so every row lands on one side.
    """
    bad = [F.coalesce(r.bad, F.lit(True)) if strict else r.bad for r in rules]
    reason = F.when(bad[0], rules[0].message)
    for condition, rule in zip(bad[1:], rules[1:]):
        reason = reason.when(condition, rule.message)
    return df.withColumns({_BAD: reduce(lambda a, b: a | b, bad), REASON: reason})


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col(_BAD)).drop(_BAD, REASON)


def rejected_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(_BAD)).drop(_BAD)


def split_valid(df: DataFrame, rules: list[Rule], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows carry their first reason.

    Both sides derive from one plan: persist ``df`` first where computing it is dear.
    """
    judged = judge(df, rules, strict)
    return valid_rows(judged), rejected_rows(judged)
