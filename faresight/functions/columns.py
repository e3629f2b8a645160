"""Scalar column functions used by the staging models, marts and ad-hoc queries.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money type used throughout (the reference stores amounts as DECIMAL(18,2);
# an unqualified NUMERIC cast is read as this type as well).
MONEY = DecimalType(18, 2)

# ---------------------------------------------------------------------------
# Payment-type code -> description.  Must equal the reference's
# macro; any other code, and NULL, maps to 'EMPTY'.
PAYMENT_TYPE_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPE_OTHER = "EMPTY"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast to DECIMAL(18,2)."""
    return _col(c).cast(MONEY)


def safe_cast(c: str | Column, to: str = "int") -> Column:
    """Bad input becomes NULL instead of failing (ANSI mode raises on ``cast``).

    Text such as ``'1.0'`` is NULL for a direct string->int ``try_cast`` in
    Spark, so integral targets also accept a number in another form if it is
    whole; ``'1.9'`` is NULL, as no integer stands for it.
    """
    col = _col(c)
    if to in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        number = col.try_cast("double")
        return F.coalesce(F.when((number == F.floor(number)) | number.isNull(), col.try_cast(to)),
                          F.when(number == F.floor(number), number.try_cast(to)))
    return col.try_cast(to)


def payment_description(c: str | Column) -> Column:
    """CASE on the (safe-cast) payment type; unknown codes and NULL -> 'EMPTY'."""
    code = safe_cast(c, "int")
    expr = None
    for k, label in PAYMENT_TYPE_DESCRIPTIONS.items():
        expr = F.when(code == k, F.lit(label)) if expr is None else expr.when(code == k, F.lit(label))
    return expr.otherwise(F.lit(PAYMENT_TYPE_OTHER))


def surrogate_key(cols: Sequence[str | Column], sep: str = "-") -> Column:
    """MD5 over the text form of ``cols`` joined by ``sep``; NULL parts are ''."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def postgres_text(c: str | Column) -> Column:
    """Text form of a DOUBLE as PostgreSQL 12 and later print ``float8::text``:
    the shortest digits that give the value back, without a needless fraction
    (``10``), plain for exponents from -4 to 14 and as ``1.5e-05`` or
    ``1e+15`` outside; ``NaN``, ``Infinity``, ``-Infinity`` and ``-0`` as such.
    Use for row ids that must equal ids computed in that database."""
    t = F.regexp_extract(_col(c).cast("string"), r"^(-?)(\d+)\.(\d+)(?:E(-?\d+))?$", 0)
    part = lambda i: F.regexp_extract(_col(c).cast("string"), r"^(-?)(\d+)\.(\d+)(?:E(-?\d+))?$", i)
    sign, whole, fraction, power = part(1), part(2), part(3), F.coalesce(part(4).try_cast("int"), F.lit(0))
    raw = F.concat(whole, fraction)
    lead = F.length(raw) - F.length(F.ltrim(raw, F.lit("0")))  # leading zeros of 0.00...
    digits = F.rtrim(F.ltrim(raw, F.lit("0")), F.lit("0"))
    exponent = F.length(whole) - 1 + power - lead  # of the first digit
    n = F.length(digits)
    plain = (F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits))
             .when(n <= exponent + 1, F.rpad(digits, exponent + 1, F.lit("0")))
             .otherwise(F.concat(F.substr(digits, F.lit(1), exponent + 1), F.lit("."), F.substr(digits, exponent + 2))))
    scientific = F.concat(F.substr(digits, F.lit(1), F.lit(1)),
                          F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")),
                          F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.lpad(F.abs(exponent).cast("string"), F.greatest(F.length(F.abs(exponent).cast("string")), F.lit(2)),
                                 F.lit("0")))
    return (F.when(_col(c).isNull(), F.lit(None).cast("string"))
            .when(t == "", _col(c).cast("string"))  # NaN, Infinity
            .when(digits == "", F.concat(sign, F.lit("0")))
            .otherwise(F.concat(sign, F.when(exponent.between(-4, 14), plain).otherwise(scientific))))


def row_hash(cols: Sequence[str | Column], sep: str = "", text_form: dict | None = None) -> Column:
    """Row id used by the insert-only merge: lower-case hex MD5 of the
    concatenated text forms, NULL parts as ''.

    ``sep=''`` keeps parity with the reference (so ``'1'+'23'`` equals
    ``'12'+'3'``); pass a separator to avoid that collision.  ``text_form``
    maps a column name to a function giving its text (e.g.
    :func:`postgres_text` for doubles); others use Spark's cast to string.
    """
    forms = text_form or {}
    parts = [F.coalesce(forms[c](c) if isinstance(c, str) and c in forms else _col(c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws(sep, *parts) if sep else F.concat(*parts))


_UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def elapsed(unit: str, start: str | Column, end: str | Column) -> Column:
    """Whole ``unit``s elapsed between two timestamps (Spark ``timestampdiff``)."""
    return F.timestamp_diff(unit.upper(), _col(start), _col(end))


def ntz_literal(value) -> Column:
    """A zone-less timestamp literal from text, a date or a datetime.

    Built from text, so the session time zone never shifts it (a Python
    ``datetime`` literal is read as a zone-aware instant first)."""
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


_EPOCH = "1970-01-01 00:00:00"


def wall_micros(ts: str | Column) -> Column:
    """Microseconds from 1970-01-01 of the wall-clock time (zone-less
    arithmetic: no session time zone or DST is involved)."""
    return F.timestamp_diff("MICROSECOND", ntz_literal(_EPOCH), _col(ts).cast("timestamp_ntz"))


def floor_div(a: Column, b: int) -> Column:
    """Exact integer floor division of a BIGINT column by a positive constant."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("bigint")


def boundaries(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    00:00:59 -> 00:02:01 is 2 minutes here but 1 with :func:`elapsed`.
    Computed on wall-clock time, independent of the session time zone.
    """
    micros = _UNIT_MICROS[unit.lower()]
    return floor_div(wall_micros(end), micros) - floor_div(wall_micros(start), micros)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed (DATEDIFF(second, a, b))."""
    return boundaries("second", start, end)


def month_start(ts: str | Column, ntz: bool = True) -> Column:
    """First instant of the month (from the calendar date, so no session
    time zone is involved); zone-less by default."""
    out = F.trunc(F.to_date(_col(ts)), "month")
    return out.cast("timestamp_ntz") if ntz else out.cast("timestamp")


def day_range(ts: str | Column, day: str | _dt.date) -> Column:
    """Half-open ``[day, day + 1)`` predicate; pushable to the parquet scan.

    Equal to ``to_date(ts) = day`` but, unlike it, a plain range on the raw
    column, so Catalyst can push it into the scan.
    """
    d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
    start = _dt.datetime.combine(d, _dt.time())
    end = start + _dt.timedelta(days=1)
    c = _col(ts)
    return (c >= ntz_literal(start)) & (c < ntz_literal(end))


def exact_mean(c: str | Column, in_scale: int, out_scale: int) -> Column:
    """Mean of a fixed-point column, rounded half away from zero to ``out_scale``.

    Computed from the exact integer sum of unscaled values and the count, so
    the result does not depend on summation order or on intermediate decimal
    rounding (plain ``avg`` on DECIMAL rounds at scale+4 first).  Returns
    DECIMAL(18, out_scale); NULL when there is no non-null input.
    """
    x = _col(c)
    unscaled = (x * F.lit(10 ** in_scale)).cast("decimal(38,0)")
    s = F.sum(unscaled)
    n = F.count(x).cast("decimal(38,0)")
    a = max(out_scale - in_scale, 0)
    b = max(in_scale - out_scale, 0)
    num = F.abs(s) * F.lit(2 * 10 ** a) + n * F.lit(10 ** b)
    den = n * F.lit(2 * 10 ** b)
    # exact integer floor division: subtract the remainder, then divide
    q = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    signed = F.when(s < 0, -q).otherwise(q)
    value = (signed.cast("decimal(38,0)") / F.lit(10 ** out_scale)).cast(DecimalType(18, out_scale))
    return F.when(n > 0, value)


def keep_keys(df: DataFrame, keys: Iterable[str], default: str = "N/A") -> DataFrame:
    """Project ``keys`` as text; a missing column or NULL value becomes ``default``."""
    present = {f.name.lower(): f.name for f in df.schema.fields}
    out = []
    for k in keys:
        src = present.get(k.lower())
        if src is None:
            out.append(F.lit(default).alias(k))
        else:
            out.append(F.coalesce(F.col(src).cast("string"), F.lit(default)).alias(k))
    return df.select(*out)


_SNAKE_1 = re.compile(r"([A-Z]+)([A-Z][a-z])")
_SNAKE_2 = re.compile(r"([a-z0-9])([A-Z])")
_SNAKE_BAD = re.compile(r"[^0-9a-zA-Z_]+")


def snake_case(name: str) -> str:
    """``Trip_Dropoff_DateTime`` -> ``trip_dropoff_date_time``; keeps ``__``
    separators and leading underscores of system columns (``_parent_id``)."""
    lead = len(name) - len(name.lstrip("_"))
    if lead:
        return name[:lead] + snake_case(name[lead:])
    parts = name.split("__")
    out = []
    for p in parts:
        p = _SNAKE_BAD.sub("_", p)
        p = _SNAKE_1.sub(r"\1_\2", p)
        p = _SNAKE_2.sub(r"\1_\2", p)
        p = re.sub(r"_+", "_", p).strip("_").lower()
        out.append(p)
    return "__".join(out)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def on_day_formatted(ts: str | Column, day: str) -> Column:
    """Parity form ``to_char(ts, 'yyyy-mm-dd') = day``.  Same rows as
    :func:`day_range`, but a function of the column, so not pushed into the
    scan; prefer :func:`day_range`."""
    return F.date_format(_col(ts), "yyyy-MM-dd") == F.lit(day)


def since_days(ts: str | Column, days: int, as_of: str | _dt.date | None = None) -> Column:
    """``ts >= as_of - INTERVAL days DAY``; ``as_of`` defaults to the current
    date and is injectable for tests and re-runs."""
    anchor = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return _col(ts) >= F.date_sub(anchor, int(days)).cast("timestamp_ntz")


def parse_timestamp(c: str | Column, fmt: str | None = None, ntz: bool = True) -> Column:
    """Text -> timestamp (``to_timestamp``); zone-less by default."""
    if ntz:
        return F.to_timestamp_ntz(_col(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(_col(c))
    return F.to_timestamp(_col(c), fmt) if fmt else F.to_timestamp(_col(c))
