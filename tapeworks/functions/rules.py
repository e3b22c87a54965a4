"""Scalar rules as column expressions: each returns null rather than a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of security and issuer identifiers.
IDENTIFIER_PATTERNS = {
    "isin": "^[A-Z]{2}[A-Z0-9]{9}[0-9]$",
    "cusip": "^[A-Z0-9]{9}$",
    "figi": "^BBG[A-Z0-9]{9}$",
    "lei": "^[A-Z0-9]{20}$",
}
#: Texts that stand for no identifier.
PLACEHOLDERS = ("N/A", "NONE", "UNKNOWN")
#: Minor currencies, the currency they divide, and by how much.
SUBUNITS = (("ILA", "ILS", 100), ("ZAC", "ZAR", 100), ("KWF", "KWD", 1000))


def cap_band(cap: Column) -> Column:
    return F.when(cap >= 10e9, "large").when(cap >= 2e9, "mid").when(cap > 0, "small")


def filing_kind(form: Column) -> Column:
    return F.when(form.isin("10-K", "10-K/A", "20-F", "20-F/A"), "annual").when(form.isin("10-Q", "10-Q/A", "6-K", "6-K/A"), "interim").otherwise("event")


def is_ceo(title: Column) -> Column:
    """Null where the title is."""
    return title.ilike("%chief executive%") | title.ilike("%ceo%")


def reporting_currency(filed: Column, quote: Column, country: Column) -> Column:
    """The filing's own; else the quote currency unless it is USD; USD only for a company of the US."""
    return F.coalesce(filed, F.when(quote != "USD", quote).when((quote == "USD") & (country == "US"), "USD"))


def period_type(p: Column) -> Column:
    p = F.lower(p)
    return F.when(p.isin("fy", "annual"), "annual").when(p.startswith("q"), "quarter").otherwise(p)


def on_read(value: Column, is_fraction: Column) -> Column:
    return F.when(is_fraction, F.round(value.cast("decimal(28,10)") * 100, 4).cast("double")).otherwise(value)


def identifier(value: Column) -> Column:
    """An identifier as it is compared: without spaces around it, in capitals."""
    return F.upper(F.trim(value))


def valid_identifier(kind: Column, value: Column) -> Column:
    """Whether the value, trimmed and in capitals, fits its kind's pattern and is neither empty, a placeholder nor one character repeated.

    A kind without a pattern takes any such value.
    """
    value = identifier(value)
    fits = ~kind.isin(*IDENTIFIER_PATTERNS)
    for name, pattern in IDENTIFIER_PATTERNS.items():
        fits |= (kind == name) & value.rlike(pattern)
    return F.coalesce(fits & (value != "") & ~value.isin(*PLACEHOLDERS) & ~value.rlike(r"^(.)\1*$"), F.lit(False))


def asset_type(category: Column, units: Column) -> Column:
    return (
        F.when(category.isin("EC", "EP"), "equity")
        .when((category == "DBT") | (category == "LON") | category.startswith("ABS-"), "bond")
        .when(category.isin("DE", "DFE"), "derivative")
        .when(category.isin("STIV", "RA"), "cash")
        .when(units == "NS", "equity")
        .otherwise("other")
    )


def plausible_rate(rate: Column) -> Column:
    return (rate > 1e-7) & (rate < 10)


def suffix(symbol: Column) -> Column:
    """The venue suffix with its dot; empty without one."""
    return F.regexp_extract(symbol, r"(\.[A-Z]+)$", 1)


def number(text: Column) -> Column:
    """A text's number, or null."""
    return F.when(text != "None", text.try_cast("double"))
