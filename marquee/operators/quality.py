"""Named data-quality rules, gates with quarantine, and expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURES = "_dq_failures"


@dataclass(frozen=True)
class Rule:
    """A row passes the rule when ``predicate`` is true."""

    name: str
    predicate: Column | str

    def column(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate


def _sql_rules(rules: Sequence[Rule]) -> bool:
    return all(isinstance(r.predicate, str) for r in rules)


def _name_literal(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def failed_rules(rules: Sequence[Rule]) -> Column:
    """array<string> of the rules a row fails, in rule order.

    A NULL predicate counts as a failure, so every row lands in exactly one of
    valid / quarantined. Rules given as SQL text become one expression.
    """
    if _sql_rules(rules):
        cases = ", ".join(
            f"CASE WHEN NOT coalesce(({r.predicate}), false) THEN {_name_literal(r.name)} END" for r in rules
        )
        return F.expr(f"array_compact(array({cases}))")
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(r.column(), F.lit(False)), F.lit(r.name)) for r in rules])
    )


def passes_all(rules: Sequence[Rule]) -> Column:
    """True when every rule holds; a NULL predicate counts as a failure."""
    if _sql_rules(rules):
        return F.expr(" AND ".join(f"coalesce(({r.predicate}), false)" for r in rules))
    return reduce(lambda a, b: a & b, [F.coalesce(r.column(), F.lit(False)) for r in rules])


def gate(df: DataFrame, rules: Sequence[Rule], null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (valid, quarantined).

    Quarantined rows keep all input columns plus ``_dq_failures``, the failed
    rule names joined by commas. Both sides are filters over the same input,
    so a pipeline that needs both materialises the input once.
    ``null_safe=False`` reproduces a plain ``filter(p)`` / ``filter(~p)``
    split, in which a row whose combined predicate is NULL lands in neither
    output.
    """
    if null_safe:
        ok = passes_all(rules)
    else:
        ok = reduce(lambda a, b: a & b, [r.column() for r in rules])
    valid = df.filter(ok)
    quarantined = df.filter(~ok).withColumn(FAILURES, F.array_join(failed_rules(rules), ","))
    return valid, quarantined


def expect(df: DataFrame, expectations: Mapping[str, str], action: str = "drop") -> DataFrame:
    """Declarative expectations: ``drop`` keeps rows passing all, ``warn`` keeps all."""
    if action == "warn":
        return df
    if action != "drop":
        raise ValueError(f"unknown expectation action: {action}")
    return df.filter(passes_all([Rule(n, sql) for n, sql in expectations.items()]))


def expectation_metrics(df: DataFrame, table: str, expectations: Mapping[str, str]) -> DataFrame:
    """One pass over ``df``: per expectation, rows passing and failing.

    Output: table_name, expectation, passed_records, failed_records (bigint).
    """
    aggs = []
    for i, sql in enumerate(expectations.values()):
        ok = F.coalesce(F.expr(sql), F.lit(False))
        aggs.append(F.count_if(ok).alias(f"p{i}"))
        aggs.append(F.count_if(~ok).alias(f"f{i}"))
    counted = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("expectation"),
                F.col(f"p{i}").alias("passed_records"),
                F.col(f"f{i}").alias("failed_records"),
            )
            for i, name in enumerate(expectations)
        ]
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(rows))
