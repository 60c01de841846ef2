"""Ordered row rules. A bad row is data: it gets a phase, a code and a reason, never an exception."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READ, PROCESS, WRITE = "read", "process", "write"
CORRUPT = "_malformed"
REJECT_COLUMNS = ("reject_phase", "reject_code", "reject_reason")


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a row to reject; null counts as not broken.

    ``reason`` may hold one ``%s``, which stands for ``value``; with ``named`` the row's subject
    goes in front.
    """

    code: str
    broken: Column
    reason: str
    value: Column | None = None
    phase: str = PROCESS
    named: bool = False


def validate(df: DataFrame, rules: Sequence[Rule], subject: Column | None = None) -> DataFrame:
    """Add the reject columns of the first broken rule. Accepted means ``reject_code IS NULL``.

    The ladder runs once per row, into the position of the rule that broke; the rest is looked up
    by that position in constant arrays. That keeps the generated code below the size at which
    the JVM stops compiling it. It is a narrow projection, no row is dropped.

    The row counter never yields a value. A column with it cannot be copied into filters, which
    keeps the optimizer from repeating the ladder, regexes and all, once per rule when a later
    step asks for ``reject_code IS NULL``.
    """
    nothing = F.when(F.monotonically_increasing_id() < 0, 0)
    ladder = reduce(lambda chain, at: chain.when(at[1].broken, at[0]), enumerate(rules), F)
    valued = [(i, rule.value) for i, rule in enumerate(rules) if rule.value is not None]
    value = reduce(lambda chain, at: chain.when(F.col("_rule") == at[0], at[1]), valued, F)
    value = value.otherwise("") if valued else F.lit("")
    before, after = zip(*(rule.reason.partition("%s")[::2] for rule in rules))
    phase, code, reason = REJECT_COLUMNS
    who = F.lit("")
    if subject is not None:
        named = [i for i, rule in enumerate(rules) if rule.named]
        who = F.when(F.col("_rule").isin(named), subject).otherwise(who)
    return (
        df.withColumn("_rule", ladder.otherwise(nothing))
        .withColumns(
            {
                phase: _pick([rule.phase for rule in rules]),
                code: _pick([rule.code for rule in rules]),
                reason: F.when(F.col("_rule").isNotNull(), F.concat(who, _pick(before), value, _pick(after))),
            }
        )
        .drop("_rule")
    )


def validated_where(
    raw: DataFrame, validator: Callable[[DataFrame], DataFrame], *conditions: Column | str
) -> DataFrame:
    """The validated rows that meet all conditions; those on raw columns alone are met before the ladder.

    The ladder's row counter keeps every later filter above it. A condition that ``raw`` can answer is put below,
    where it reaches the scan; one on typed or reject columns stays above. Both mean the same, as a validator keeps
    its raw columns as they are.
    """
    late = []
    for condition in conditions:
        try:
            raw = raw.where(condition)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            late.append(condition)
    return reduce(DataFrame.where, late, validator(raw))


def _pick(values: Sequence[str]) -> Column:
    """The value at the position of the broken rule, null when none broke."""
    return F.get(F.array(*(F.lit(v) for v in values)), F.col("_rule"))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_code").isNull())


def rejected(validated: DataFrame, raw_columns: Sequence[str]) -> DataFrame:
    """The reject trail: order key, raw columns, phase, code and reason."""
    return validated.where(F.col("reject_code").isNotNull()).select("seq", *raw_columns, *REJECT_COLUMNS)
