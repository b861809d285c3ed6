"""Scalar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Each function documents the SQL behaviour it reproduces, in particular the
NULL and rounding rules where Spark's defaults differ from the reference's
database or pandas.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.rules import RISK_EDGES, RISK_LABELS

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day(ts: ColumnOrName) -> Column:
    """X1 ``DATE(ts)``: the calendar day of a date or timestamp."""
    return F.to_date(_c(ts))


def _ntz(x: ColumnOrName) -> Column:
    # zone-free timestamps: day and month differences never depend on the session zone
    return _c(x).cast("timestamp_ntz")


def months_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """X2 ``TIMESTAMPDIFF(MONTH, start, end)``: whole months.

    2001-01-31 -> 2001-02-28 is 0 (the day of month is not reached yet);
    ``months_between`` would round this to 1, so it is not used.
    """
    return F.timestamp_diff("MONTH", _ntz(start), _ntz(end)).cast("int")


def days_diff_24h(start: ColumnOrName, end: ColumnOrName) -> Column:
    """X3 ``TIMESTAMPDIFF(DAY, start, end)``: whole 24-hour days (times count)."""
    return F.timestamp_diff("DAY", _ntz(start), _ntz(end)).cast("int")


def datediff_days(end: ColumnOrName, start: ColumnOrName) -> Column:
    """X4 ``DATEDIFF(end, start)``: calendar days, times ignored."""
    return F.datediff(day(end), day(start))


def as_of_date(as_of: str) -> Column:
    """X5 ``CURDATE()`` replaced by an explicit reference date."""
    return F.lit(as_of).cast("date")


def clean_zero_date(x: ColumnOrName) -> Column:
    """X7 ``NULLIF(x, '0000-00-00')`` for date text: zero or invalid dates become NULL.

    Applied where text dates are loaded; comparing a date column with the
    zero-date string would fail under ANSI casts.
    """
    text = F.trim(_c(x).cast("string"))
    zero = text.startswith("0000-00-00")
    return F.when(zero | (text == ""), F.lit(None).cast("date")).otherwise(
        F.coalesce(F.try_to_date(text, "yyyy-MM-dd HH:mm:ss"), F.try_to_date(text, "yyyy-MM-dd"))
    )


def contains_ci(text: ColumnOrName, word: str) -> Column:
    """X10 ``LOWER(x) LIKE '%word%'``; NULL text gives NULL (false in filters)."""
    return F.lower(_c(text)).contains(word.lower())


def not_contains_ci_keep_null(text: ColumnOrName, word: str) -> Column:
    """F3 ``LOWER(COALESCE(x, '')) NOT LIKE '%word%'``: NULL text is kept."""
    return ~F.lower(F.coalesce(_c(text), F.lit(""))).contains(word.lower())


#: Neither case nor accents.
CI_AI = "UNICODE_CI_AI"


def like_ci(text: ColumnOrName, pattern: str) -> Column:
    """X11 ``x LIKE pattern`` under the original database's default collation,
    which compares neither case nor accents (``NÃO`` is like ``nao``).

    Patterns with ``%`` at their ends only are substring tests under Spark's
    ``UNICODE_CI_AI`` collation; ``LIKE`` itself takes no such collation, so
    other patterns compare without case but with accents.
    """
    word = pattern.strip("%")
    if "%" in word or "_" in word:
        return _c(text).ilike(pattern)
    t, w = F.collate(_c(text), CI_AI), F.collate(F.lit(word), CI_AI)
    if pattern.startswith("%") and pattern.endswith("%"):
        return t.contains(w)
    return F.endswith(t, w) if pattern.startswith("%") else F.startswith(t, w) if pattern.endswith("%") else t == w


def greatest_strict(*cols: ColumnOrName) -> Column:
    """X12 MySQL ``GREATEST``: NULL if any argument is NULL.

    Spark's ``greatest`` skips NULLs, so the NULL case is made explicit.
    """
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def guarded_datediff(end: ColumnOrName, start: ColumnOrName) -> Column:
    """X13 duration only when the end exists and is not before the start, else NULL."""
    e, s = _c(end), _c(start)
    return F.when(e.isNotNull() & (e >= s), datediff_days(e, s))


def conditional(predicate: Column, value: Column) -> Column:
    """X14 ``CASE WHEN predicate THEN value END`` (no ELSE: NULL, skipped by AVG)."""
    return F.when(predicate, value)


def fallback_duration(start: ColumnOrName, end: ColumnOrName, fallback: ColumnOrName) -> Column:
    """X15 days from start to the end date, else to the fallback (latest history) date."""
    return days_diff_24h(start, F.coalesce(_c(end), _c(fallback)))


def recency_days(
    churn: ColumnOrName,
    cancel_date: ColumnOrName,
    last_task: ColumnOrName,
    signature: ColumnOrName,
    as_of: str,
) -> Column:
    """X16 days since the last task (or the signature when there is none).

    Churned: to the cancel date, floored at 0 (NULL stays NULL); active: to ``as_of``.
    """
    since = F.coalesce(_c(last_task), _c(signature))
    return F.when(
        _c(churn) == 1, greatest_strict(F.lit(0), datediff_days(cancel_date, since))
    ).otherwise(datediff_days(as_of_date(as_of), since))


def product_code(group: ColumnOrName, codes: Sequence[tuple[str, int]]) -> Column:
    """X17 product group text -> product code; first matching text wins, else NULL."""
    g = _c(group)
    out = None
    for text, code in codes:
        cond = like_ci(g, f"%{text}%")
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out


def open_flag(status_value: ColumnOrName, finished: Iterable[str]) -> Column:
    """X18 1 when the task status is not a finished one, else 0 (NULL status: 0)."""
    return F.when(~_c(status_value).isin(list(finished)), 1).otherwise(0)


def to_decimal(x: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """X19 ``CAST(x AS DECIMAL(p, s))``; overflow gives NULL instead of an error."""
    return _c(x).try_cast(f"decimal({precision},{scale})")


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """X20 ``a * 1.0 / b`` as double; division by zero gives NULL (no ANSI error)."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def percent(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``(a * 1.0 / b) * 100`` as double, NULL when b is 0 or NULL."""
    return ratio(numerator, denominator) * F.lit(100.0)


def round_half_even(x: ColumnOrName, digits: int = 2) -> Column:
    """X21 pandas/numpy ``round(digits)``: ``rint(x * 10**d) / 10**d``.

    numpy scales, rounds half to even, and scales back, in doubles; the same
    expression here gives the same doubles (``bround`` works on decimals and
    differs in a few cases).
    """
    scale = float(10**digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def decimal_comma_to_double(x: ColumnOrName) -> Column:
    """X22 ``'1,5'`` -> 1.5; empty or invalid text -> NULL."""
    return F.replace(F.trim(_c(x).cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def risk_segment(p: ColumnOrName) -> Column:
    """X23 ``pd.cut(p, [0, .3, .7, 1], include_lowest=True)`` labels; outside -> NULL."""
    c = _c(p)
    lo, a, b, hi = RISK_EDGES
    return (
        F.when((c >= lo) & (c <= a), F.lit(RISK_LABELS[0]))
        .when((c > a) & (c <= b), F.lit(RISK_LABELS[1]))
        .when((c > b) & (c <= hi), F.lit(RISK_LABELS[2]))
    )


def risk_segment_rank(p: ColumnOrName) -> Column:
    """Order of the segment labels (0, 1, 2); NULL outside [0, 1]."""
    c = _c(p)
    lo, a, b, hi = RISK_EDGES
    return (
        F.when((c >= lo) & (c <= a), F.lit(0))
        .when((c > a) & (c <= b), F.lit(1))
        .when((c > b) & (c <= hi), F.lit(2))
    )


def rule(predicate_sql: str) -> Column:
    """A rule predicate from ``churnlens.rules`` as a Column."""
    return F.expr(predicate_sql)
