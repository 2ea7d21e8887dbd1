"""Calendar rules as column expressions (no per-row Python, no lookup join).

Weekday numbers follow Spark's ``weekday``: Monday = 0 ... Sunday = 6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MON, TUE, WED, THU, FRI, SAT, SUN = range(7)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(x) -> Column:
    """Column as is, a string as a column name, anything else as a literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def nth_weekday(year, month, weekday: int, n: int) -> Column:
    """Date of the n-th ``weekday`` (Mon=0) of ``month`` in ``year``; n >= 1."""
    first = F.make_date(_lit(year), _lit(month), F.lit(1))
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + F.lit(7 * (n - 1)))


def last_weekday(year, month, weekday: int) -> Column:
    last = F.last_day(F.make_date(_lit(year), _lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


def thanksgiving(year) -> Column:
    """Fourth Thursday of November."""
    return nth_weekday(year, 11, THU, 4)


def thanksgiving_text(year) -> Column:
    """Thanksgiving as ``yyyy-11-dd`` text."""
    return F.date_format(thanksgiving(year), "yyyy-MM-dd")


def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus) as a DATE."""
    y = _lit(year).cast("int")

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    a = F.pmod(y, F.lit(19))
    b = div(y, 100)
    c = F.pmod(y, F.lit(100))
    d = div(b, 4)
    e = F.pmod(b, F.lit(4))
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = div(c, 4)
    k = F.pmod(c, F.lit(4))
    l = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = div(a + 11 * h + 22 * l, 451)
    n = h + l - 7 * m + 114
    return F.make_date(y, div(n, 31), F.pmod(n, F.lit(31)) + 1)


def _parts(d: Column):
    return F.month(d), F.dayofmonth(d), F.weekday(d), F.year(d)


# FIXED VALUES: first year in which a federal holiday fell by the rule used here.
FIRST_YEARS = {
    "martinLutherKingJrDay": 1986,
    "washingtonsBirthday": 1971,
    "memorialDay": 1971,
    "juneteenthNationalIndependenceDay": 2021,
    "laborDay": 1894,
    "columbusDay": 1971,
    "thanksgivingDay": 1942,
}


def federal_holiday_flags(date: Column | str) -> dict[str, Column]:
    """Thirteen US federal holiday flags (int 0/1) by public rule.

    Observed days: a holiday on Saturday is observed the Friday before, on
    Sunday the Monday after.  Only New Year's Day and Veterans Day carry an
    "observed" flag; other observed days set no flag.  A rule holds from its
    first year (FIRST_YEARS); before it the flag is 0.
    """
    d = _c(date)
    m, dd, wd, y = _parts(d)

    def flag(cond: Column) -> Column:
        return F.coalesce(cond.cast("int"), F.lit(0))

    return {
        "newYearsDay": flag((m == 1) & (dd == 1)),
        "newYearsDayObserved": flag(((m == 1) & (dd == 2) & (wd == MON)) | ((m == 12) & (dd == 31) & (wd == FRI))),
        "martinLutherKingJrDay": flag((m == 1) & (wd == MON) & dd.between(15, 21) & (y >= FIRST_YEARS["martinLutherKingJrDay"])),
        "washingtonsBirthday": flag((m == 2) & (wd == MON) & dd.between(15, 21) & (y >= FIRST_YEARS["washingtonsBirthday"])),
        "memorialDay": flag((m == 5) & (wd == MON) & (dd >= 25) & (y >= FIRST_YEARS["memorialDay"])),
        "juneteenthNationalIndependenceDay": flag((m == 6) & (dd == 19) & (y >= FIRST_YEARS["juneteenthNationalIndependenceDay"])),
        "independenceDay": flag((m == 7) & (dd == 4)),
        "laborDay": flag((m == 9) & (wd == MON) & (dd <= 7) & (y >= FIRST_YEARS["laborDay"])),
        "columbusDay": flag((m == 10) & (wd == MON) & dd.between(8, 14) & (y >= FIRST_YEARS["columbusDay"])),
        "veteransDayObserved": flag((m == 11) & (((dd == 10) & (wd == FRI)) | ((dd == 12) & (wd == MON)))),
        "veteransDay": flag((m == 11) & (dd == 11)),
        "thanksgivingDay": flag((m == 11) & (wd == THU) & dd.between(22, 28) & (y >= FIRST_YEARS["thanksgivingDay"])),
        "christmasDay": flag((m == 12) & (dd == 25)),
    }


# FIXED VALUES: fixed month/day observances (name, month, day).
FIXED_DATES = (
    ("newYearsEve", 12, 31),
    ("christmasEve", 12, 24),
    ("valentinesDay", 2, 14),
    ("halloween", 10, 31),
)


def fixed_date_flags(date: Column | str) -> dict[str, Column]:
    d = _c(date)
    return {
        name: F.coalesce(((F.month(d) == mo) & (F.dayofmonth(d) == dy)).cast("int"), F.lit(0))
        for name, mo, dy in FIXED_DATES
    }


def thanksgiving_family_flags(date: Column | str) -> dict[str, Column]:
    """thanksgiving (4th Thursday of November), blackFriday (+1 day), cyberMonday (+4 days)."""
    d = _c(date)
    tg = thanksgiving(F.year(d))
    return {
        "thanksgiving": F.coalesce((d == tg).cast("int"), F.lit(0)),
        "blackFriday": F.coalesce((d == F.date_add(tg, 1)).cast("int"), F.lit(0)),
        "cyberMonday": F.coalesce((d == F.date_add(tg, 4)).cast("int"), F.lit(0)),
    }


def easter_flag(date: Column | str) -> Column:
    d = _c(date)
    return F.coalesce((d == easter_sunday(F.year(d))).cast("int"), F.lit(0))
