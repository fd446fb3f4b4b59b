"""Numbers out of text, and rounding that two engines agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(value: Column) -> Column:
    """A double as decimal: sums, ratios and rounding from here on are exact."""
    return value.cast("decimal(28,12)")


def rounded(value: Column, places: int) -> Column:
    return F.round(exact(value), places)


def digits_number(value: Column) -> Column:
    """All digits of a price text as a whole number; null without digits."""
    return F.nullif(F.regexp_replace(value.cast("string"), r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def positive(value: Column) -> Column:
    return F.when(value > 0, value)


def is_number(value: Column) -> Column:
    """Whether a VARIANT is a JSON number."""
    return F.coalesce(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)"), F.lit(False))


def money(value: Column) -> Column:
    """A JSON number as it is; of text, 1.234,5 is 1234.5, and with one kind of separator only, all separators go."""
    text = F.regexp_replace(F.try_variant_get(value, "$", "string"), r"[^0-9,.\-]", "")
    both = text.contains(",") & text.contains(".")
    plain = F.when(both, F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.regexp_replace(text, "[.,]", ""))
    return F.when(is_number(value), F.try_variant_get(value, "$", "double")).otherwise(F.nullif(plain, F.lit("")).try_cast("double"))


def currency_price(value: Column) -> Column:
    """The number before a currency mark, else all digits; positive only."""
    text = value.cast("string")
    marked = F.nullif(F.regexp_extract(text, r"(?i)(\d[\d.\s,]*)\s*(?:₫|đ|VND)", 1), F.lit(""))
    return positive(digits_number(F.coalesce(marked, text)))


def payload_price(value: Column) -> Column:
    """A positive JSON number without its fraction, or the price in a text."""
    number = F.try_variant_get(value, "$", "double")
    return F.when(is_number(value) & (number > 0), number.cast("bigint")).when(~is_number(value), currency_price(F.try_variant_get(value, "$", "string")))


def discount_label(price: Column, list_price: Column, sign: str = "-") -> Column:
    """-N%, half to even, of the list price in doubles; empty without a discount."""
    percent = F.bround((list_price - price) * F.lit(100) / list_price.cast("double")).cast("int")
    return F.when((list_price > 0) & (price > 0) & (price < list_price), F.concat(F.lit(sign), percent.cast("string"), F.lit("%"))).otherwise("")


def valid_gtin(value: Column) -> Column:
    """The trimmed text where it is a GTIN of 8, 12, 13 or 14 digits with a right check digit."""
    text = F.trim(value.cast("string"))
    signs = F.split(F.lpad(text, 14, "0"), "")
    weighted = F.transform(F.slice(signs, 1, 13), lambda d, i: d.try_cast("int") * F.when(i % 2 == 0, 3).otherwise(1))
    total = F.aggregate(weighted, F.lit(0), lambda a, x: a + x)
    ok = text.rlike("^(?:[0-9]{8}|[0-9]{12,14})$") & ((10 - total % 10) % 10 == F.substring(text, -1, 1).try_cast("int"))
    return F.when(ok, text)
