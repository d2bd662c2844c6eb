"""Statistic windows: cyclical look-back periods and calendar months.

Every window is returned as a struct column with the fields
``period`` (label), ``s``/``e`` (current window, inclusive dates) and
``p_s``/``p_e`` (previous window, inclusive dates).  All windows are plain
column expressions over literals derived from one ``as_of`` date, so Catalyst
folds them into constants and no lookup table or range join is needed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cyclical look-back windows in lookup order, as day offsets
# from the as-of day: (label, start, end, previous start, previous end).
# A date is assigned the first window whose [start, end] contains it.
CYCLICAL_PERIODS = (
    ("Yesterday", -1, -1, -2, -2),
    ("SevenDays", -7, -1, -14, -8),
    ("ThirtyDays", -30, -1, -60, -31),
    ("SixtyDays", -60, -1, -120, -61),
    ("NinetyDays", -90, -1, -180, -91),
    ("SixMonths", -180, -1, -360, -181),
    ("OneYear", -360, -1, -720, -361),
)

WINDOW_FIELDS = ("period", "s", "e", "p_s", "p_e")


def as_date(value) -> _dt.date:
    """Accept a ``datetime.date`` or a ``yyyy-MM-dd`` string."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def cyclical_table(as_of) -> list[tuple[str, _dt.date, _dt.date, _dt.date, _dt.date]]:
    """The seven look-back windows as concrete dates for one as-of day."""
    day = as_date(as_of)
    return [
        (name, *(day + _dt.timedelta(days=off) for off in offsets))
        for name, *offsets in CYCLICAL_PERIODS
    ]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _d(day: _dt.date) -> str:
    return f"DATE'{day.isoformat()}'"


def _case(branches: list[tuple[str, str]], default: str = "NULL") -> Column:
    """One SQL CASE expression: a single JVM call however many branches."""
    body = " ".join(f"WHEN {cond} THEN {value}" for cond, value in branches)
    return F.expr(f"CASE {body} ELSE {default} END")


def cyclical_index(latest: str, as_of) -> Column:
    """0-based index into :data:`CYCLICAL_PERIODS` of the first window holding
    column ``latest``; null when no window holds it (latest on/after ``as_of``
    or more than 360 days back)."""
    c = _q(latest)
    return _case(
        [(f"{c} >= {_d(s)} AND {c} <= {_d(e)}", str(i)) for i, (_, s, e, _, _) in enumerate(cyclical_table(as_of))]
    )


def cyclical_window(latest: str, as_of) -> Column:
    """Struct (period, s, e, p_s, p_e) of the cyclical window of column
    ``latest``, or null when there is none."""
    c = _q(latest)
    branches = []
    for name, s, e, p_s, p_e in cyclical_table(as_of):
        value = f"named_struct('period', '{name}', 's', {_d(s)}, 'e', {_d(e)}, 'p_s', {_d(p_s)}, 'p_e', {_d(p_e)})"
        branches.append((f"{c} >= {_d(s)} AND {c} <= {_d(e)}", value))
    return _case(branches)


def month_window(day: str, calendar_months: bool = False) -> Column:
    """Struct (period ``yyyy-MM``, s, e, p_s, p_e) of the calendar month of
    column ``day``; null when ``day`` is null.

    By default the previous window ends on ``last_day(day)`` moved back one
    month with day-of-month clamping, so after a 30-day month the previous
    31-day month loses its last day (2018-06 -> 2018-05-01..2018-05-30).
    ``calendar_months=True`` uses the true last day of the previous month.
    """
    c = _q(day)
    prev_end = f"last_day(add_months({c}, -1))" if calendar_months else f"add_months(last_day({c}), -1)"
    value = (
        f"named_struct('period', date_format({c}, 'yyyy-MM'), 's', trunc({c}, 'MM'), 'e', last_day({c}), "
        f"'p_s', add_months(trunc({c}, 'MM'), -1), 'p_e', {prev_end})"
    )
    return _case([(f"{c} IS NOT NULL", value)])


def in_window(day: Column, window: Column, previous: bool = False) -> Column:
    """``day`` lies in the (current or previous) inclusive window."""
    lo, hi = ("p_s", "p_e") if previous else ("s", "e")
    return day.between(window[lo], window[hi])


# Dates outside every window: lower end of the first slot, upper end of the last.
FAR_PAST = "0001-01-01"
FAR_FUTURE = "9999-12-31"



def cut_dates(as_of) -> list[_dt.date]:
    """Every date at which some cyclical window (current or previous) starts
    or the day after it ends, ascending."""
    cuts = set()
    for _, s, e, p_s, p_e in cyclical_table(as_of):
        one = _dt.timedelta(days=1)
        cuts.update((s, e + one, p_s, p_e + one))
    return sorted(cuts)


def floor_to_cut(day: str, cuts: list[_dt.date]) -> Column:
    """Largest cut date <= column ``day`` (``FAR_PAST`` below the first cut).

    A predicate ``day >= c`` or ``day < c`` for a cut ``c`` has the same value
    on ``day`` and on ``floor_to_cut(day)``, so rows can be grouped by it."""
    c = _q(day)
    branches = [(f"{c} >= {_d(cut)}", _d(cut)) for cut in reversed(cuts)]
    branches.append((f"{c} IS NOT NULL", f"DATE'{FAR_PAST}'"))
    return _case(branches)


def time_slot(day: str, as_of) -> tuple[Column, Column]:
    """First and last day of the slot holding column ``day``.

    Slots split the calendar at every cyclical window edge and, inside each
    month, into days 1-28 and the single days 29, 30 and 31.  Every window
    used by the metrics (look-back windows, a calendar month, the previous
    month up to a given month-end day) is a union of whole slots, so a slot
    lies entirely inside or outside it and ``slot_first >= s AND slot_last <=
    e`` decides membership exactly.
    """
    c = _q(day)
    cuts = cut_dates(as_of)
    one = _dt.timedelta(days=1)
    age_first = " ".join(f"WHEN {c} >= {_d(cut)} THEN {_d(cut)}" for cut in reversed(cuts))
    age_last = " ".join(f"WHEN {c} < {_d(cut)} THEN {_d(cut - one)}" for cut in cuts)
    short = f"dayofmonth({c}) <= 28"
    first = (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest("
        f"CASE {age_first} ELSE DATE'{FAR_PAST}' END, "
        f"CASE WHEN {short} THEN trunc({c}, 'MM') ELSE {c} END) END"
    )
    last = (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE least("
        f"CASE {age_last} ELSE DATE'{FAR_FUTURE}' END, "
        f"CASE WHEN {short} THEN date_add(trunc({c}, 'MM'), 27) ELSE {c} END) END"
    )
    return F.expr(first), F.expr(last)


def slot_in_window(first: Column, last: Column, window: Column, previous: bool = False) -> Column:
    """A whole slot lies in the (current or previous) window."""
    lo, hi = ("p_s", "p_e") if previous else ("s", "e")
    return (first >= window[lo]) & (last <= window[hi])
