"""Promotion cards: buy-X-get-Y phrases, their mechanics, and products they belong to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.numbers import digits_number
from pricelake.functions.text import collapsed, strip_marks
from pricelake.operators.dedupe import dedupe

#: Folded words of a mechanic. The fold keeps đ, so "đồng giá" is not among what "dong gia" finds.
MECHANIC_WORDS = ("tang", "voi gia", "tinh tien", "dong gia")
LONGEST = 320


def plain(text: Column) -> Column:
    """Without accents, đ kept, lower case."""
    return F.lower(strip_marks(text, d_stroke=False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _is_phrase(phrase: Column) -> Column:
    def spoken(low: Column) -> Column:
        word = low.contains(MECHANIC_WORDS[0])
        for w in MECHANIC_WORDS[1:]:
            word = word | low.contains(w)
        return word & low.rlike(r"\bmua\s+\d+")

    return (phrase != "") & (F.length(phrase) <= LONGEST) & let(plain(phrase), spoken)


def _lines(card: Column) -> Column:
    return F.filter(F.transform(F.split(card, r"\R"), collapsed), lambda x: x != "")


def phrases(card: Column) -> Column:
    """Promotion phrases of a card's text: its lines; only if none, windows of two, then three lines."""
    window = lambda lines, n: F.transform(lines, lambda _, i: collapsed(F.array_join(F.slice(lines, i + 1, n), " ")))
    wide = lambda lines: F.filter(F.concat(window(lines, 2), window(lines, 3)), _is_phrase)
    alone = lambda lines: let(F.filter(lines, _is_phrase), lambda found: F.when(F.size(found) > 0, found).otherwise(wide(lines)))
    firsts = lambda chosen: let(F.transform(chosen, plain), lambda low: F.filter(chosen, lambda _, i: F.array_position(low, low[i]) == i + 1))
    return let(let(_lines(card), alone), firsts)


def mechanic(phrase: Column) -> Column:
    """What a phrase offers, tried in order: buy and get, bundle price, buy and pay."""
    get = r"\bmua\s+(\d+)\s*([a-z0-9]+)?\b.{0,100}?(?:duoc\s+)?tang\s+(\d+)\s*([a-z0-9]+)?"
    bundle = r"\bmua\s+(\d+)\s*([a-z0-9]+)?\b.{0,80}?voi\s+gia\s+([\d.,]+)"
    pay = r"\bmua\s+(\d+)\b.{0,80}?tinh\s+tien\s+(\d+)"

    def terms(low: Column, kind: Column) -> Column:
        t = lambda pattern, k: F.nullif(F.regexp_extract(low, pattern, k), F.lit(""))
        n = lambda pattern, k: t(pattern, k).try_cast("int")
        price = digits_number(t(bundle, 3))
        only = lambda k, x: F.when(kind == k, x)
        return F.struct(
            kind.alias("promo_mechanic_type"),
            F.when(kind == "buy_x_get_y", n(get, 1)).when(kind == "buy_x_pay_y", n(pay, 1)).alias("buy_quantity"),
            only("buy_x_get_y", t(get, 2)).alias("buy_uom"),
            only("buy_x_get_y", n(get, 3)).alias("gift_quantity"),
            only("buy_x_get_y", t(get, 4)).alias("gift_uom"),
            only("bundle_price", n(bundle, 1)).alias("bundle_quantity"),
            only("bundle_price", t(bundle, 2)).alias("bundle_uom"),
            only("bundle_price", price).alias("bundle_price"),
            only("bundle_price", F.when(n(bundle, 1) > 0, F.round((price / n(bundle, 1)).cast("decimal(28,12)"), 2))).alias("effective_unit_price"),
            only("buy_x_pay_y", n(pay, 2)).alias("pay_quantity"),
        )

    kind = lambda low: F.when(low.rlike(get), "buy_x_get_y").when(low.rlike(bundle), "bundle_price").when(low.rlike(pay), "buy_x_pay_y").otherwise("unknown")
    return let(plain(phrase), lambda low: let(kind(low), lambda k: terms(low, k)))


def product_name(anchor: Column, card: Column) -> Column:
    """The link's text, else the card's first line of at least eight signs that is no phrase and no price."""

    def fits(line: Column, found: Column) -> Column:
        low = plain(line)
        spoken = low.contains("mua ") | low.contains(" voi gia ") | low.contains(" duoc tang ")
        priced = line.contains("₫") | low.rlike(r"\d+[.,]\d{3}\s*d\b")
        return (F.length(line) >= 8) & ~F.array_contains(found, low) & ~spoken & ~priced

    return F.coalesce(F.nullif(collapsed(anchor), F.lit("")), let(F.transform(phrases(card), plain), lambda found: F.try_element_at(F.filter(_lines(card), lambda line: fits(line, found)), F.lit(1))))


def promo_rows(cards: DataFrame) -> DataFrame:
    """One row per card and phrase, first of equal (item, text, url); high confidence with an item number."""
    rows = cards.withColumn("promo_mechanic_text", F.explode(phrases(F.col("card_text"))))
    first = dedupe(rows, ["item_no", "promo_mechanic_text", "url"], [F.col("card_id")])
    return first.withColumn("promo", mechanic(F.col("promo_mechanic_text"))).withColumn("match_confidence", F.when(F.col("item_no").isNotNull(), "high").otherwise("low"))


def without_product(cards: DataFrame, products: DataFrame) -> DataFrame:
    """Items of cards that have no product yet, by their first card."""
    missing = cards.filter("item_no <> ''").join(products.select("item_no").distinct(), "item_no", "left_anti")
    return dedupe(missing, ["item_no"], [F.col("card_id")])


def hydrated(missing: DataFrame, payloads: DataFrame) -> DataFrame:
    """Missing items found in landed payloads; the first payload by path that holds the item."""
    found = payloads.groupBy("item_no").agg(F.min_by("product", "path").alias("product"))
    return missing.select("item_no").join(found, "item_no").withColumn("hydration", F.lit("existing_payload"))


def with_hydrated(products: DataFrame, extra: DataFrame) -> DataFrame:
    """Products and the hydrated ones that they lack; the earlier row of an item stays."""
    both = products.withColumn("_side", F.lit(0)).unionByName(extra.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    return dedupe(both, ["item_no"], [F.col("_side"), *[F.col(c).cast("string") for c in sorted(products.columns)]]).drop("_side")


def uom_status(hint: Column, uoms: Column) -> Column:
    return F.when(hint.isNull(), "no_uom_hint").when(F.size(uoms) == 0, "no_product_uoms").when(F.array_contains(uoms, hint), "matched").otherwise("unmatched")


def attach(products: DataFrame, promos: DataFrame) -> DataFrame:
    """Products with their promotions as an array, matched by item number; units are compared per match."""
    hint = F.coalesce(*[F.nullif(F.trim(plain(F.col(f"promo.{f}"))), F.lit("")) for f in ("buy_uom", "bundle_uom", "gift_uom")])
    nested = promos.filter("item_no <> ''").groupBy("item_no").agg(F.array_sort(F.collect_list(F.struct("card_id", "promo_mechanic_text", hint.alias("uom_hint")))).alias("promos"))
    rows = products.join(nested, "item_no", "left").withColumn("promos", F.coalesce("promos", F.array().cast(nested.schema["promos"].dataType)))
    own = F.array_distinct(F.array_compact(F.transform("uoms", lambda u: F.nullif(F.trim(plain(u)), F.lit("")))))
    cut = F.coalesce(F.col("promo_price") < F.col("listed_price"), F.lit(False))
    return rows.withColumns(
        {
            "promo_card_match_count": F.size("promos").cast("long"),
            "uom_statuses": let(own, lambda units: F.transform("promos", lambda m: uom_status(m["uom_hint"], units))),
            "has_promo_mechanic": F.size("promos") > 0,
            "is_price_discount": cut,
            "is_on_promotion": cut | (F.size("promos") > 0),
        }
    )


def unmatched(promos: DataFrame, products: DataFrame) -> DataFrame:
    """Promotions without a product, those without an item number among them."""
    return promos.join(products.select("item_no").distinct(), "item_no", "left_anti")


def merge_summary(attached: DataFrame, promos: DataFrame | None = None, statuses: DataFrame | None = None) -> DataFrame:
    """Counts of a merge in one row. With the cards: how many were read, found no product, and name no
    item; with the matches' uom_match_status: how many matches have each."""
    row = attached.agg(
        F.count("*").alias("products_read"),
        F.count_if("is_price_discount").alias("products_with_price_discount"),
        F.count_if("has_promo_mechanic").alias("products_with_promo_cards"),
        F.count_if("is_on_promotion").alias("products_on_promotion"),
        F.coalesce(F.sum("promo_card_match_count"), F.lit(0)).alias("promo_card_matches"),
    )
    if promos is not None:
        without = F.coalesce(F.col("item_no"), F.lit("")) == ""
        row = row.join(F.broadcast(promos.agg(F.count("*").alias("promo_cards_read"), F.count_if(without).alias("promo_cards_without_item_no"))))
        row = row.join(F.broadcast(unmatched(promos, attached).agg(F.count("*").alias("promo_cards_unmatched"))))
    if statuses is not None:
        counted = statuses.groupBy(F.coalesce("uom_match_status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))
        row = row.join(F.broadcast(counted.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("uom_match_status_counts"))))
    return row
