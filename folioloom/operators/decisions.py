"""Decision tables: rules as rows of conditions, a fact and the domain that it must be in, judged in one scan of the facts.

A rule applies where each fact of ``when`` has one of its values (a null fact has none).  It then asks its ``fact`` to be
``given`` (not null, not blank), ``in`` its values, ``not_in`` them, ``at_least`` its value, or the ``same`` as the
fact that its value names.  A null fact is in no domain, at least nothing and the same as nothing; it is ``not_in`` every one.
Facts are columns of any type, compared as text but for ``at_least``.  Several rules may share an id: a row violates the id once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.operators.contracts import RowRule, row_violations

TESTS = ("given", "in", "not_in", "at_least", "same")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    fact: str
    test: str
    values: tuple[str, ...] = ()
    when: dict[str, tuple[str, ...]] = field(default_factory=dict)
    severity: str = "error"


def _text(fact: str) -> Column:
    return F.col(f"`{fact}`").cast("string")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def violated(rule: Rule) -> Column:
    """True where ``rule`` applies to a row and the row breaks it."""
    fact = _text(rule.fact)
    if rule.test == "given":
        kept = _sure(F.trim(fact) != "")
    elif rule.test == "in":
        kept = _sure(fact.isin(*rule.values))
    elif rule.test == "not_in":
        kept = ~_sure(fact.isin(*rule.values))
    elif rule.test == "at_least":
        kept = _sure(fact.try_cast("double") >= float(rule.values[0]))
    elif rule.test == "same":
        kept = _sure(fact == _text(rule.values[0]))
    else:
        raise ValueError(f"{rule.rule_id}: {rule.test} is not one of {', '.join(TESTS)}")
    applies = F.lit(True)
    for name, values in rule.when.items():
        applies = applies & _sure(_text(name).isin(*values))
    return applies & ~kept


def decide(facts: DataFrame, rules: Iterable[Rule], key: Column) -> DataFrame:
    """(rule_id, severity, key): one row for each rule id that a row of ``facts`` breaks; no shuffle."""
    by_id: dict[tuple[str, str], Column] = {}
    for r in rules:
        at = (r.rule_id, r.severity)
        by_id[at] = by_id[at] | violated(r) if at in by_id else violated(r)
    return row_violations(facts, key, [RowRule(rule_id, c, severity) for (rule_id, severity), c in by_id.items()])
