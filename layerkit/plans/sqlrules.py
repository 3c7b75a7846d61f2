"""The holiday rules of ``functions.calendar`` rendered as DuckDB SQL (for the oracles)."""

from __future__ import annotations

from ..functions.calendar import FIXED_HOLIDAYS, WEEKDAY_HOLIDAYS


def _fixed(d: str, m: int, day: int, since) -> str:
    c = f"(month({d}) = {m} and day({d}) = {day})"
    return f"({c} and year({d}) >= {since})" if since else c


def holiday_sql(d: str) -> str:
    conds = []
    for _, m, day, since in FIXED_HOLIDAYS:
        conds.append(_fixed(d, m, day, since))
        conds.append(f"(isodow({d}) = 5 and {_fixed(f'({d} + 1)', m, day, since)})")
        conds.append(f"(isodow({d}) = 1 and {_fixed(f'({d} - 1)', m, day, since)})")
    for _, m, wd, n, since in WEEKDAY_HOLIDAYS:
        c = f"(month({d}) = {m} and isodow({d}) = {wd}"
        c += f" and ceil(day({d}) / 7) = {n}" if n > 0 else f" and month({d} + 7) <> {m}"
        if since:
            c += f" and year({d}) >= {since}"
        conds.append(c + ")")
    return "(" + " or ".join(conds) + ")"
