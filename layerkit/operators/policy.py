"""Row access and column masking policies as DataFrame transforms for a declared role set.

Enforcement (who may read the base table) is the platform's job; these shape the rows
and values a role sees. The rules table is small by construction (roles x values) and is
applied as an ``isin`` filter when given as a literal list, else as a semi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_row_policy(df: DataFrame, column: str, rules: dict[str, list[str] | None], roles: set[str]) -> DataFrame:
    """``rules``: role -> allowed values of ``column`` (None = all rows). Roles not in ``rules`` see nothing."""
    active = [r for r in roles if r in rules]
    if any(rules[r] is None for r in active):
        return df
    allowed = sorted({v for r in active for v in rules[r]})
    if not allowed:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).isin(allowed))


def apply_row_policy_table(df: DataFrame, column: str, rules: DataFrame, roles: set[str]) -> DataFrame:
    """Same with the rules as a relation ``(role, value)``; a NULL value grants all rows.

    The rules relation is tiny (roles x values); the filter is a left semi-join that Catalyst
    broadcasts by its size statistics.
    """
    r = rules.filter(F.col("role").isin(sorted(roles)))
    if not r.filter(F.col("value").isNull()).isEmpty():
        return df
    return df.join(r.select(F.col("value").alias(column)).distinct(), column, "left_semi")


def mask(column: str, allowed_roles: set[str], roles: set[str], masked: str = "***") -> Column:
    """Value when any of the session's roles is allowed, else the mask text."""
    if set(roles) & set(allowed_roles):
        return F.col(column)
    return F.lit(masked)


def apply_mask(df: DataFrame, column: str, allowed_roles: set[str], roles: set[str], masked: str = "***") -> DataFrame:
    return df.withColumn(column, mask(column, allowed_roles, roles, masked))


def protected_view(df: DataFrame, roles: set[str], *, row_rules: tuple[str, dict] | None = None,
                   masks: dict[str, set[str]] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Report view over a protected base table: row filter first (on unmasked values), then masks."""
    out = df
    if row_rules:
        col, rules = row_rules
        out = apply_row_policy(out, col, rules, roles)
    for c, allowed in (masks or {}).items():
        out = apply_mask(out, c, allowed, roles)
    return out.select(*columns) if columns else out
