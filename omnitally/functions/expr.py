"""Reusable column expressions.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage code generation. Money is kept as ``decimal``; ratios are rounded half-up
through integer cents so the result is exact and engine independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
MONEY_SUM = "decimal(18,2)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_instant(c: str | Column) -> Column:
    """A naive UTC wall-clock (timestamp_ntz) as a ``timestamp`` instant, in any session zone
    (a plain cast would read the wall-clock in the session zone). The offset is written
    into the text, so hours that a zone repeats are told apart."""
    return F.concat(col_(c).cast("timestamp_ntz").cast("string"), F.lit("+00:00")).cast("timestamp")


def utc_wallclock(c: str | Column) -> Column:
    """A ``timestamp`` instant as its UTC wall-clock (timestamp_ntz), in any session zone:
    its microseconds since the epoch, added to the epoch's wall-clock."""
    seconds = (F.unix_micros(col_(c).cast("timestamp")).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)"))
    none = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds.cast("decimal(18,6)"))


def utc_ts(c: str | Column) -> Column:
    """ISO-8601 text (with 'Z' or an offset) to the UTC wall-clock as timestamp_ntz.

    Independent of the session time zone, also in hours that it repeats or skips.
    """
    return utc_wallclock(F.to_timestamp(col_(c)))


def money(c: str | Column) -> Column:
    """Cast to the warehouse money type (strings and doubles; no float step for strings)."""
    return col_(c).cast(MONEY)


def minor_to_money(c: str | Column) -> Column:
    """Minor currency units (bigint cents) to decimal(14,2)."""
    return (col_(c).cast("decimal(18,0)") * F.lit(0.01)).cast(MONEY)


def cents(c: str | Column) -> Column:
    """decimal(.,2) amount to bigint cents (exact)."""
    return (col_(c) * 100).cast("bigint")


def int_div(a: str | Column, b: str | Column) -> Column:
    """Exact integral division of bigints (SQL ``a div b``)."""
    return F.call_function("div", col_(a).cast("bigint"), col_(b).cast("bigint"))


def half_up(num: str | Column, den: str | Column) -> Column:
    """round(num / den) of bigints (den > 0), halves away from zero."""
    n, d = col_(num).cast("bigint"), col_(den).cast("bigint")
    size = int_div(F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -size).otherwise(size)


def cents_to_money(c: str | Column) -> Column:
    """bigint cents to decimal(14,2) (exact)."""
    return (col_(c).cast("decimal(18,0)") * F.lit(0.01)).cast(MONEY)


def ratio_2dp(num: str | Column, den: str | Column, num_in_cents: bool = True) -> Column:
    """num / den rounded half-up to 2 decimals as decimal(14,2); 0.00 when den <= 0.

    ``num`` is an integer amount of cents, or a plain count when ``num_in_cents`` is False.
    """
    n = col_(num).cast("bigint")
    if not num_in_cents:
        n = n * 100
    d = col_(den).cast("bigint")
    return F.when(d > 0, cents_to_money(half_up(n, d))).otherwise(F.lit(0).cast(MONEY))


def pct(part_cents: str | Column, total_cents: str | Column) -> Column:
    """100 * part / total as double from exact integer operands; 0 when total <= 0."""
    p, t = col_(part_cents).cast("double"), col_(total_cents).cast("double")
    return F.when(t > 0, (F.lit(100.0) * p) / t).otherwise(F.lit(0.0))


def growth_pct(cur: str | Column, prev: str | Column) -> Column:
    """(cur - prev) / prev * 100 as double, 0 when prev <= 0 (report growth rule)."""
    c, p = col_(cur).cast("double"), col_(prev).cast("double")
    return F.when(p > 0, ((c - p) / p) * F.lit(100.0)).otherwise(F.lit(0.0))


def strip_ws(c: str | Column) -> Column:
    """JavaScript-style trim: strips all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def pii_hash(c: str | Column) -> Column:
    """lower + trim + SHA-256 hex, first 32 chars; null or empty input gives null."""
    norm = strip_ws(F.lower(col_(c)))
    return F.when(col_(c).isNull() | (col_(c) == ""), F.lit(None).cast("string")) \
        .otherwise(F.substring(F.sha2(norm, 256), 1, 32))


def customer_hash(email: str | Column, phone: str | Column) -> Column:
    """Email preferred, phone otherwise, null when both are absent."""
    return F.coalesce(pii_hash(email), pii_hash(phone))


def external_id(gid: str | Column, vendor: str = "shop") -> Column:
    """``gid://x/Type/123`` -> ``<vendor>_type_123``; type 'unknown', id the whole string."""
    parts = F.split(col_(gid), "/")
    typ = F.coalesce(F.nullif(F.lower(F.try_element_at(parts, F.lit(4))), F.lit("")), F.lit("unknown"))
    ident = F.coalesce(F.nullif(F.try_element_at(parts, F.lit(5)), F.lit("")), col_(gid))
    return F.concat(F.lit(vendor + "_"), typ, F.lit("_"), ident)


def surrogate_id(*cols: str | Column) -> Column:
    """Repeatable key from a natural key (same on retry, unlike uuid())."""
    return F.sha2(F.concat_ws("|", *[col_(c).cast("string") for c in cols]), 256)


def ratio_dp(num: str | Column, den: str | Column, dp: int) -> Column:
    """num / den (integers) rounded half-up to ``dp`` decimals; 0 when den <= 0."""
    n = col_(num).cast("bigint") * (10 ** dp)
    d = col_(den).cast("bigint")
    out = f"decimal(18,{dp})"
    scaled = half_up(n, d).cast("decimal(18,0)") * F.lit(10 ** -dp if dp else 1).cast(f"decimal({dp + 1},{dp})")
    return F.when(d > 0, scaled.cast(out)).otherwise(F.lit(0).cast(out))


def merge_json(raw: str | Column, fields: dict[str, Column]) -> Column:
    """Object spread-merge: add or replace top-level keys of a JSON object, types kept.

    ``{...raw, k: v}``: the object is read as a map of VARIANT values, so numbers, booleans,
    nested objects and arrays stay what they are; new values keep their column's type (a
    VARIANT column, as of ``parse_json``, adds any JSON value). A null, malformed or
    non-object text counts as an empty object; later keys win.
    """
    base = F.coalesce(F.from_json(col_(raw), "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    extra = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("variant"))])
    return F.to_json(F.map_concat(F.map_filter(base, lambda k, _: ~k.isin(list(fields))), extra))
