"""Pack sizes out of product texts: selling unit, pack count, area, mass and volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import folded

#: Folded selling units and their names.
SELLING_UNITS = {
    "bich": "pack",
    "bo": "set",
    "chai": "bottle",
    "can": "can",
    "cai": "each",
    "cay": "each",
    "chiec": "each",
    "cuon": "roll",
    "goi": "pack",
    "hop": "box",
    "kg": "kg",
    "loc": "multi_pack",
    "lon": "can",
    "thung": "case",
    "tui": "bag",
    "vi": "blister",
    "vien": "piece",
}
#: Words for packs before a number, and for pieces after one.
PACK_WORDS = ("loc", "thung", "vi", "bo", "hop")
COUNT_WORDS = ("cai", "chiec", "chai", "lon", "goi", "hop", "cuon", "vien")
#: Units of which a price per unit may be published without a measurement.
PUBLISHABLE_UNITS = ("each", "roll", "set", "blister")

#: The patterns' units and bounds. The end of a unit is a look-ahead, since a word boundary
#: of Java's patterns doesn't know letters beyond ASCII.
PACK_PATTERN = rf"\b(?:{'|'.join(PACK_WORDS)})\s*(\d{{1,3}})\b"
INLINE_PATTERN = rf"\b(\d{{1,3}})\s*(?:{'|'.join(COUNT_WORDS)})\b"
AREA_PATTERN = r"\b(\d{2,4}(?:[,.]\d+)?)\s*[x*]\s*(\d{2,4}(?:[,.]\d+)?)(?:\s*cm)?\b"
MEASURE_PATTERN = r"(\d+(?:[,.]\d+)?)\s*(?:kg|g|gr|gram|ml|l|lit|lít)(?![\p{L}\p{N}_])"


def selling_unit(unit: Column) -> Column:
    """The unit's name; unknown text passes through folded, blank is null."""
    known = F.create_map(*[F.lit(x) for pair in SELLING_UNITS.items() for x in pair])
    text = F.nullif(folded(unit), F.lit(""))
    return F.coalesce(F.try_element_at(known, text), text)


def _number(text: Column) -> Column:
    return F.nullif(F.replace(text, F.lit(","), F.lit(".")), F.lit("")).try_cast("double")


def with_package(df: DataFrame, name: Column, size: Column, unit: Column) -> DataFrame:
    """df with all that is known about the package of a listing.

    Area comes first, then the last mass or volume in the text, then the selling unit. The
    steps are separate projections: each extract is computed once and the code stays small.
    """
    low = F.lower(F.concat_ws(" ", F.nullif(size, F.lit("")), F.nullif(name, F.lit(""))))
    df = df.select("*", low.alias("_low"), folded(low).alias("_folded"), unit.alias("selling_unit_raw"), selling_unit(unit).alias("_unit"))
    flat = F.replace(F.col("_low"), F.lit("×"), F.lit("x"))
    df = df.select(
        "*",
        _number(F.regexp_extract(flat, AREA_PATTERN, 1)).alias("_length"),
        _number(F.regexp_extract(flat, AREA_PATTERN, 2)).alias("_width"),
        F.try_element_at(F.regexp_extract_all("_low", F.lit(MEASURE_PATTERN), F.lit(0)), F.lit(-1)).alias("_measure"),
        _number(F.regexp_extract("_folded", PACK_PATTERN, 1)).alias("_packs"),
        _number(F.regexp_extract("_folded", INLINE_PATTERN, 1)).alias("_pieces"),
    )
    sign = F.regexp_extract("_measure", r"\p{L}+$", 0)
    df = df.select(
        "*",
        _number(F.regexp_extract("_measure", r"^\d+(?:[,.]\d+)?", 0)).alias("_quantity"),
        F.when(sign == "kg", "kg").when(sign.isin("g", "gr", "gram"), "g").when(sign.isin("l", "lit", "lít"), "l").when(sign == "ml", "ml").alias("_sign"),
        F.when(F.col("_packs") > 1, F.col("_packs")).when(F.col("_pieces") > 1, F.col("_pieces")).otherwise(1.0).alias("_count"),
        F.when(F.col("_packs") > 1, "pack_count").when(F.col("_pieces") > 1, "inline_count").otherwise("selling_unit_raw").alias("_count_source"),
    )
    kind = F.when((F.col("_length") > 0) & (F.col("_width") > 0), "area").when((F.col("_quantity") > 0) & F.col("_sign").isNotNull(), "measure").when(F.col("_unit").isNotNull(), "unit").otherwise("none")
    df = df.select("*", kind.alias("_kind"), F.col("_sign").isin("kg", "g").alias("_mass"), F.col("_unit").isin(*PUBLISHABLE_UNITS).alias("_plain"))

    def choose(area, measure, fallback, nothing=None):
        column = lambda x: x if isinstance(x, Column) else F.lit(x)
        k = F.col("_kind")
        return F.when(k == "area", column(area)).when(k == "measure", column(measure)).when(k == "unit", column(fallback)).otherwise(column(nothing))

    area, c = F.col("_length") * F.col("_width"), F.col
    base = c("_quantity") * F.when(c("_sign").isin("kg", "l"), 1000.0).otherwise(1.0)
    kept = [x for x in df.columns if not x.startswith("_") or x in ("_metadata",)]
    return df.select(
        *kept,
        c("_unit").alias("selling_unit_normalized"),
        F.when(c("_kind") != "none", c("_count")).alias("selling_unit_count"),
        choose("area", F.when(c("_mass"), "mass").otherwise("volume"), "count", "unknown").alias("measurement_type"),
        choose(area, c("_quantity"), 1.0).alias("measurement_quantity"),
        choose("cm2", c("_sign"), "each").alias("measurement_unit"),
        choose(area, base, 1.0).alias("measurement_base_quantity"),
        choose("cm2", F.when(c("_mass"), "g").otherwise("ml"), "each").alias("measurement_base_unit"),
        choose(area * c("_count"), base * c("_count"), c("_count")).alias("package_total_base_quantity"),
        choose("product_name_raw", "product_name_raw", c("_count_source")).alias("package_parse_source"),
        choose("medium", "medium", F.when(c("_plain"), "medium").otherwise("low"), "none").alias("package_parse_confidence"),
        choose("parsed_area", "parsed_measurement", "selling_unit_fallback", "parse_failed").alias("package_parse_status"),
        choose(True, True, c("_plain"), False).alias("unit_price_publishable"),
        F.when(c("_kind") == "area", c("_length")).alias("dimension_length_cm"),
        F.when(c("_kind") == "area", c("_width")).alias("dimension_width_cm"),
    )


#: Columns that ``with_package`` adds.
PACKAGE_COLUMNS = [
    *["selling_unit_raw", "selling_unit_normalized", "selling_unit_count", "measurement_type", "measurement_quantity", "measurement_unit"],
    *["measurement_base_quantity", "measurement_base_unit", "package_total_base_quantity", "package_parse_source", "package_parse_confidence"],
    *["package_parse_status", "unit_price_publishable", "dimension_length_cm", "dimension_width_cm"],
]
