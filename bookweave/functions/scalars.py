"""Times, prices, quantities, symbols and comparison rules as Column expressions, all in integers or decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC8_MS = 28_800_000
DAY_MS = 86_400_000


def _int(c: Column, start: int, length: int) -> Column:
    return F.substring(c, start, length).try_cast("bigint")


def _calendar(day: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of the month of a YYYYMMDD, as they stand."""
    return _div(day, F.lit(10_000)), _div(day, F.lit(100)) % 100, day % 100


def day_epoch_ms(day: Column) -> Column:
    """First millisecond (UTC) of a YYYYMMDD trading day; null if there is no such day."""
    date = F.when(valid_day(day), F.make_date(*(c.cast("int") for c in _calendar(day))))
    return F.unix_date(date).cast("bigint") * DAY_MS


def clock_ms(text: Column) -> Column:
    """Milliseconds since midnight of HH:MM:SS.mmm (second 60 is legal); null for any other text."""
    good = text.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)\.[0-9]{3}$")
    return F.when(good, ((_int(text, 1, 2) * 60 + _int(text, 4, 2)) * 60 + _int(text, 7, 2)) * 1000 + _int(text, 10, 3))


def market_ts(day: Column, text: Column) -> Column:
    """Epoch milliseconds of an exchange time (UTC+8)."""
    return day_epoch_ms(day) + clock_ms(text) - UTC8_MS


def time_of_day(ms: Column) -> Column:
    """Milliseconds since midnight at UTC+8."""
    return F.pmod(ms + UTC8_MS, F.lit(DAY_MS))


def valid_day(day: Column) -> Column:
    """Whether an integer is a Gregorian YYYYMMDD; by arithmetic, as every row asks for it."""
    y, m, d = _calendar(day)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.coalesce(day.between(10_000_101, 99_991_231) & m.between(1, 12) & d.between(1, last), F.lit(False))


def to_units(price: Column, scale: int) -> Column:
    """Price of scale 3 or 4 in units of 0.0001; any other scale is refused."""
    if scale not in (3, 4):
        raise ValueError(f"price scale {scale}")
    return (price.cast(f"decimal(38,{scale})") * F.lit(10_000).cast("decimal(10,0)")).cast("bigint")


def rescaled(raw: Column, scale: int, to: int = 4) -> Column:
    """A non-negative integer at `scale` digits as one at `to` digits, half up."""
    if scale <= to:
        return raw * F.lit(10 ** (to - scale))
    d = 10 ** (scale - to)
    return _div(raw + F.lit(d // 2), F.lit(d))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ref_price(raw: Column, scale: int) -> Column:
    """A published price in units: nothing for null, zero or negative (see ref_price_error)."""
    return F.when(raw > 0, rescaled(raw, scale))


def ref_price_error(raw: Column) -> Column:
    return F.coalesce(raw < 0, F.lit(False))


def ref_amount(raw: Column, scale: int) -> Column:
    """A published amount: zero is a value, null or negative is an error and gives null."""
    return F.when(raw >= 0, rescaled(raw, scale))


def ref_quantity(raw: Column, market: str) -> Column:
    """A published quantity: SH has three digits and must be whole, SZ is an integer; errors give null."""
    if market == "SH":
        return F.when((raw >= 0) & (raw % 1000 == 0), _div(raw, F.lit(1000)))
    return F.when(raw >= 0, raw)


def is_symbol(symbol: Column) -> Column:
    return symbol.rlike("^[0-9]{6}$")


#: Three-digit prefixes by class and market.
PREFIXES = {
    ("stock", "SH"): ["600", "601", "603", "605", "688", "689"],
    ("stock", "SZ"): ["000", "001", "002", "003", "300", "301", "302"],
    ("etf", "SH"): ["510", "511", "512", "513", "515", "516", "517", "518", "560", "561", "562", "563", "588"],
    ("etf", "SZ"): ["159"],
    ("chinext", "SZ"): ["300", "301", "302"],
}


def symbol_prefix(symbol: Column) -> Column:
    return F.substring(symbol, 1, 3)


def in_class(market: Column, symbol: Column, kind: str) -> Column:
    """Whether a symbol is a `stock`, `etf` or `chinext` of its market."""
    of = [(market == m) & symbol_prefix(symbol).isin(p) for (k, m), p in PREFIXES.items() if k == kind]
    any_ = of[0]
    for x in of[1:]:
        any_ = any_ | x
    return F.coalesce(any_ & is_symbol(symbol), F.lit(False))  # the prefix first: it spares most rows the pattern


def symbol_class(market: Column, symbol: Column) -> Column:
    return F.when(in_class(market, symbol, "etf"), "etf").when(in_class(market, symbol, "chinext"), "chinext").when(in_class(market, symbol, "stock"), "stock").otherwise("other")


def quantum(market: Column, kind: Column) -> Column:
    """Units to which prices are compared: SH 10, SZ funds 10, SZ stocks 100."""
    return F.when((market == "SZ") & kind.isin("stock", "chinext"), 100).otherwise(10).cast("bigint")


def rounded(price: Column, q: Column) -> Column:
    """A price half up to a quantum."""
    return _div(price + _div(q, F.lit(2)), q) * q


def weighted_price(total: Column, quantity: Column) -> Column:
    """Half-up average in units of a side; null for an empty side. total: sum of price times quantity."""
    return F.when(quantity > 0, _div(total + _div(quantity, F.lit(2)), quantity))


def weighted_price_q(total: Column, quantity: Column, q: Column) -> Column:
    """The average rounded once, to the quantum."""
    return F.when(quantity > 0, _div(total + _div(quantity * q, F.lit(2)), quantity * q) * q)


def weighted_match(a: Column, b: Column, within: int = 10) -> Column:
    return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= within, F.lit(False))


def missing_reception(seq_no: Column, local_time: Column) -> Column:
    return seq_no.isNull() & (local_time.isNull() | (F.trim(local_time) == ""))


def turnover_compat(missing: Column, expected: Column, actual: Column) -> Column:
    """Whether turnovers agree: equal, or, where reception fields are missing, equal once ours has 12 significant digits."""
    e, a = expected.cast("decimal(38,0)"), actual.cast("decimal(38,0)")
    digits = F.length(a.cast("string"))
    p = F.concat(F.lit("1"), F.repeat(F.lit("0"), F.greatest(digits - 12, F.lit(0)))).cast("decimal(38,0)")
    low = a % p
    return (e == a) | (missing & (a - low + F.when(low * 2 >= p, p).otherwise(F.lit(0).cast("decimal(38,0)")) == e))


def close_band(base: Column) -> Column:
    """struct(low, high): ten per cent round a base price, half up to 100 units and at least one tick away, low at least 100. Null for a base that is no positive multiple of 100."""
    good = (base > 0) & (base % 100 == 0)
    low = F.greatest(F.lit(100), F.least(base - 100, _div(base * 9 + 500, F.lit(1000)) * 100))
    high = F.greatest(base + 100, _div(base * 11 + 500, F.lit(1000)) * 100)
    return F.when(good, F.struct(low.alias("low"), high.alias("high")))


#: How a missing upper limit is published.
NO_LIMIT, NO_LIMIT_ROUNDED = 9_999_999_999_999, 10_000_000_000_000


def limit_class(high: Column, low: Column, missing: Column) -> Column:
    """`unlimited`, `limited` or `invalid` for a pair of daily limits in units."""
    none = ((high == NO_LIMIT) & low.isin(100, -NO_LIMIT)) | ((high == NO_LIMIT_ROUNDED) & (low == 100) & missing)
    return F.when(high.isNull() | low.isNull(), "invalid").when(none, "unlimited").when((low > 0) & (low <= high) & (high < NO_LIMIT) & (high % 100 == 0) & (low % 100 == 0), "limited").otherwise("invalid")
