"""Generic Column helpers with the NULL/rounding semantics the survey rules need.

Spark and the usual SQL engines differ from the rules' source dialect in a few
places (SURVEY 2.M); each helper here pins one of them down so the recode
functions can stay declarative.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _all_not_null(cols: list[Column]) -> Column:
    cond = cols[0].isNotNull()
    for c in cols[1:]:
        cond = cond & c.isNotNull()
    return cond


def greatest_strict(*cols: str | Column) -> Column:
    """GREATEST that is NULL when any argument is NULL (Spark's skips NULLs)."""
    cs = [col(c) for c in cols]
    return F.when(_all_not_null(cs), F.greatest(*cs))


def least_strict(*cols: str | Column) -> Column:
    """LEAST that is NULL when any argument is NULL (Spark's skips NULLs)."""
    cs = [col(c) for c in cols]
    return F.when(_all_not_null(cs), F.least(*cs))


def to_long_rounded(c: str | Column) -> Column:
    """Float -> BIGINT rounding half away from zero (Spark's cast truncates); text must be a whole number."""
    c = col(c)
    return F.when(F.typeof(c) == "string", c.cast("string").cast("bigint")).otherwise(F.round(c).cast("bigint"))


def try_to_long_rounded(c: str | Column) -> Column:
    """Like ``to_long_rounded`` but NULL instead of an error: for overflow, and for text that is no whole number ('2.0' is none)."""
    c = col(c)
    return F.when(F.typeof(c) == "string", c.cast("string").try_cast("bigint")).otherwise(
        F.round(c.try_cast("decimal(38,18)")).try_cast("bigint"))


def code_label(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Simple CASE over a code list: first matching code wins, NULL never matches."""
    c = col(c)
    out = None
    for code, label in mapping.items():
        out = F.when(c == F.lit(code), F.lit(label)) if out is None else out.when(c == F.lit(code), F.lit(label))
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def clock_hhm(hour: str | Column, minute: str | Column) -> Column:
    """HHMM as an integer via '%02d%02d' text, NULL when the text is not a number.

    995/995 gives 995995 and -1/-1 gives NULL, which ``h*100+m`` would not.
    """
    return F.format_string("%02d%02d", col(hour), col(minute)).try_cast("bigint")


def minutes_after_midnight(hour: str | Column, minute: str | Column) -> Column:
    return col(hour) * 60 + col(minute)


def star_except(df: DataFrame, drop: Iterable[str]) -> list[Column]:
    """All columns of ``df`` except ``drop``; raises on a name that is not there.

    ``DataFrame.drop`` silently ignores unknown names, SQL's ``* EXCEPT`` does
    not; a misspelt drop list must fail loudly.
    """
    drop = list(drop)
    present = {c.lower() for c in df.columns}
    missing = [d for d in drop if d.lower() not in present]
    if missing:
        raise ValueError(f"star_except: columns not found: {missing}")
    dropped = {d.lower() for d in drop}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in dropped]


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> None:
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]
