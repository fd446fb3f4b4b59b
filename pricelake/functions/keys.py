"""Deterministic SHA-256 keys over '|'-joined parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTRACT_VERSION = 1
UNKNOWN_STORE = "unknown_store"
ONLINE_STORE = "online_default"


def part(value: Column, numeric: bool = False) -> Column:
    """A key part: null is empty, and so is a numeric zero."""
    text = number_text(value) if numeric else value.cast("string")
    return F.coalesce(F.nullif(text, F.lit("0")) if numeric else text, F.lit(""))


def number_text(value: Column) -> Column:
    """A number as fixed decimal text without trailing zeros, alike for whole and broken numbers."""
    text = value.cast("decimal(28,6)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def surrogate(prefix: str, *parts: Column) -> Column:
    """``prefix_`` and the first 24 hex digits of the parts' digest."""
    return F.concat(F.lit(prefix + "_"), F.substring(digest(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 1, 24))


def identity_key(method: Column, value: Column) -> Column:
    """The method is part of the digest; the visible prefix is always ``prod_``."""
    return F.concat(F.lit("prod_"), F.substring(digest(method, value), 1, 24))


def listing_key(retailer: Column, source_id: Column, sku: Column, uom: Column) -> Column:
    """A missing source id counts as the text None."""
    return digest(retailer, F.coalesce(source_id, F.lit("None")), F.coalesce(sku, F.lit("")), F.coalesce(uom, F.lit("")))


def observation_key(listing: Column, store: Column, observed_at: Column, bronze_key: Column) -> Column:
    return digest(listing, F.coalesce(store, F.lit("None")), F.coalesce(observed_at, F.lit("None")), bronze_key)


def snapshot_key(date: Column, retailer: Column, store: Column, listing: Column) -> Column:
    return digest(date.cast("string"), retailer, store, listing)


def bronze_key(retailer: Column, run: Column, dataset: Column, file: Column, payload_sha: Column, occurrence: Column) -> Column:
    return digest(F.lit(str(CONTRACT_VERSION)), retailer, run, dataset, file, payload_sha, occurrence.cast("string"))


def store_or_unknown(store: Column) -> Column:
    return F.coalesce(F.nullif(store, F.lit("")), F.lit(UNKNOWN_STORE))
