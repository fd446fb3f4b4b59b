"""Landing: retailers' own payloads to canonical offers.

Every adapter takes a table with ``payload`` (VARIANT) and gives one canonical offer per
usable payload; the rest is dropped by its filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.functions.keys import ONLINE_STORE
from pricelake.functions.numbers import digits_number, discount_label, money, payload_price, positive
from pricelake.functions.text import collapsed
from pricelake.operators.bronze import text_at
from pricelake.sources.shared import small_side

ZONE = "Asia/Ho_Chi_Minh"
#: Hosts and routes of product pages.
BHX_HOSTS = ("bachhoaxanh.com", "www.bachhoaxanh.com")
GO_SITE, MM_SITE, LOTTE_SITE, BHX_SITE = "https://go-vietnam.vn", "https://online.mmvietnam.com", "https://www.lottemart.vn", "https://www.bachhoaxanh.com"


def clean(payload: Column, field: str) -> Column:
    """A field's text with white space collapsed; null where blank."""
    return F.nullif(collapsed(text_at(payload, field)), F.lit(""))


def price(payload: Column, field: str) -> Column:
    """Digits of a number or text, if positive; a fraction of a JSON number is cut off."""
    text = F.regexp_replace(text_at(payload, field), r"^(\d+)\.\d+$", "$1")
    return positive(digits_number(text))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with further columns that are computed once for each row. A projection's expressions
    are copied into the filters above it, as often as these name them; a generator's are not."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def with_lowered(payloads: DataFrame) -> DataFrame:
    """The payload and ``f``, a map of its fields, as VARIANT, by lower-cased key; the first of equal keys stays."""
    fields = F.try_variant_get("payload", "$", "map<string,variant>")
    rows = once(payloads.select("payload"), _fields=fields)
    rows = once(rows, _keys=F.transform(F.map_keys("_fields"), lambda k: F.lower(k)))
    firsts = F.filter(F.arrays_zip(F.col("_keys").alias("key"), F.map_values("_fields").alias("value")), lambda e, i: F.array_position("_keys", e["key"]) == i + 1)
    plain = F.size(F.array_distinct("_keys")) == F.size("_keys")
    lowered = F.when(plain, F.map_from_arrays("_keys", F.map_values("_fields"))).otherwise(F.map_from_entries(firsts))
    return once(rows, f=lowered).drop("_fields", "_keys")


def text_of(value: Column) -> Column:
    """A VARIANT scalar as text with white space collapsed; null for blank text, objects and arrays."""
    nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(~nested, F.nullif(collapsed(F.try_variant_get(value, "$", "string")), F.lit("")))


def first_value(fields: Column, names: list[str]) -> Column:
    """The first non-empty value of lower-cased fields by case-insensitive name, as VARIANT."""
    values = [F.try_element_at(fields, F.lit(n.lower())) for n in names]
    return F.coalesce(*[F.when(text_of(v).isNotNull(), v) for v in values])


def first_text(fields: Column, names: list[str]) -> Column:
    """The text of ``first_value``."""
    return F.coalesce(*[text_of(F.try_element_at(fields, F.lit(n.lower()))) for n in names])


#: Canonical columns and the adapters' columns that may hold them, the first filled one counts.
CANONICAL = {
    "store_code": ["store_code", "store_site_code"],
    "source_product_id": ["product_id", "sku", "barcode"],
    "product_name_raw": ["name"],
    "brand_raw": ["brand"],
    "category_raw": ["category_name", "category_full_path"],
    "unit_raw": ["unit"],
    "source_url": ["product_url", "url", "source_url"],
    "image_url": ["image_url", "image", "thumbnail_url", "thumbnail"],
    "observed_at": ["crawled_at"],
}


def envelope(offers: DataFrame, retailer: str) -> DataFrame:
    """Canonical names over adapters' ones: prices, flags, store, source and id; the offer as it
    came is kept as raw_product, a VARIANT."""
    c = F.col
    filled = lambda names: F.coalesce(*[F.nullif(c(n).cast("string"), F.lit("")) for n in names if n in offers.columns], F.lit(None).cast("string"))
    named = {canonical: filled(names) for canonical, names in CANONICAL.items()}
    cut = F.coalesce((c("sale_price") > 0) & (c("original_price") > c("sale_price")), F.lit(False))
    spoken = F.coalesce(F.trim("promotion") != "", F.lit(False))
    return offers.withColumns(
        {
            **named,
            "raw_product": F.to_variant_object(F.struct(*offers.columns)),
            "retailer_id": F.lit(retailer),
            "store_code": F.coalesce(named["store_code"], F.lit(ONLINE_STORE)),
            "current_price": c("sale_price"),
            "listed_price": c("original_price"),
            "promo_price": F.when(cut, c("sale_price")),
            "currency": F.lit("VND"),
            "is_price_discount": cut,
            "has_promo_mechanic": spoken & ~cut,
            "is_on_promotion": F.lit(True),
        }
    )


def _web(text: Column) -> Column:
    return F.coalesce(text.rlike("^https?://"), F.lit(False))


def go_offers(payloads: DataFrame) -> DataFrame:
    """Sale test, detail lookup by key words, first image; a lower member price is the sale price.
    The category is a payload's own, as the page that it came from says."""
    p = F.col("payload")
    sale, listed, member = price(p, "price"), price(p, "promotion_price"), price(p, "member_price")
    gifts = F.size(F.coalesce(F.try_variant_get(p, "$.gift.list", "array<variant>"), F.array()))
    detail = F.try_variant_get(p, "$.detail", "array<struct<name:string,value:string>>")
    looked = lambda words: F.coalesce(collapsed(F.try_element_at(F.filter(detail, lambda d: reduce(lambda a, b: a | b, [F.lower(d["name"]).contains(w) for w in words])), F.lit(1))["value"]), F.lit(""))
    image = F.coalesce(clean(p, "images[0].url"), clean(p, "images[0]"), clean(p, "image"))
    original = F.when(listed != sale, listed)
    on_sale = F.coalesce(listed > sale, F.lit(False)) | F.coalesce(member < sale, F.lit(False)) | (gifts > 0)
    return payloads.filter(clean(p, "name").isNotNull() & sale.isNotNull() & _web(image) & on_sale).select(
        clean(p, "name").alias("name"),
        F.coalesce(clean(p, "product_url"), F.concat(F.lit(GO_SITE + "/products/"), clean(p, "alias"), F.lit("-i."), clean(p, "id")), clean(p, "dynamic_link")).alias("url"),
        image.alias("image"),
        F.when(member < sale, member).otherwise(sale).alias("sale_price"),
        original.alias("original_price"),
        discount_label(sale, original).alias("discount"),
        F.coalesce(clean(p, "gift.title"), clean(p, "message_product"), clean(p, "short_detail_note"), F.lit("")).alias("promotion"),
        clean(p, "barcode").alias("barcode"),
        clean(p, "id").alias("product_id"),
        looked(["trọng lượng", "dung tích"]).alias("unit"),
        looked(["thương hiệu"]).alias("brand"),
        looked(["xuất xứ", "sản xuất tại"]).alias("origin"),
        clean(p, "category_id").alias("category_id"),
        clean(p, "category_name").alias("category_name"),
        member.alias("member_price"),
        F.coalesce(clean(p, "member_price_start_date"), clean(p, "member_price_start_time"), F.lit("")).alias("sale_start_at"),
        F.coalesce(clean(p, "member_price_end_date"), clean(p, "member_price_end_time"), F.lit("")).alias("sale_end_at"),
        F.coalesce(text_at(p, "status") == "1", F.lit(False)).alias("in_stock"),
    )


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds as ISO text in +07:00; empty for none."""
    local = F.timestamp_seconds(positive(seconds.try_cast("bigint")) + 7 * 3600)
    return F.coalesce(F.concat(F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), local.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")), F.lit(""))


def lotte_offers(payloads: DataFrame) -> DataFrame:
    p, c = F.col("payload"), F.col
    sale = F.coalesce(price(p, "price.VND.special_price"), price(p, "price.VND.default"))
    listed = F.coalesce(price(p, "price.VND.price"), price(p, "price.VND.default_original"))
    image, url = F.coalesce(clean(p, "image_url"), clean(p, "thumbnail_url")), clean(p, "url")
    labels = F.try_variant_get(p, "$.label", "array<struct<name:string>>")
    rows = once(payloads, _name=clean(p, "name"), _url=url, _image=image, _sale=sale, _listed=listed)
    good = c("_name").isNotNull() & c("_sale").isNotNull() & _web(c("_image")) & c("_url").startswith(LOTTE_SITE) & c("_url").contains("/product/")
    return rows.filter(good).select(
        c("_name").alias("name"),
        c("_url").alias("url"),
        c("_image").alias("image"),
        c("_sale").alias("sale_price"),
        F.when(c("_listed") != c("_sale"), c("_listed")).alias("original_price"),
        F.coalesce(clean(p, "price.VND.default_discount_label"), F.lit("")).alias("discount"),
        F.lit("").alias("promotion"),
        clean(p, "sku").alias("sku"),
        clean(p, "id").alias("product_id"),
        F.coalesce(F.filter(F.transform(labels, lambda x: collapsed(x["name"])), lambda x: x != ""), F.array().cast("array<string>")).alias("labels"),
        epoch_text(text_at(p, "price.VND.special_from_date")).alias("sale_start_at"),
        epoch_text(text_at(p, "price.VND.special_to_date")).alias("sale_end_at"),
    )


def local_time(text: Column) -> Column:
    """Date or date and time as ISO text in +07:00; other text as it is; empty for none."""
    flat = F.nullif(collapsed(text), F.lit(""))
    stamp = F.when(flat.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(flat, F.lit("T00:00:00+07:00"))).when(
        flat.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), F.concat(F.replace(flat, F.lit(" "), F.lit("T")), F.lit("+07:00"))
    )
    return F.coalesce(stamp, flat, F.lit(""))


def mm_offers(payloads: DataFrame) -> DataFrame:
    """Promotions and categories as arrays; the sale lasts from the least start to the greatest end; a
    lower card price wins."""
    p = F.col("payload")
    plain, listed, card = F.col("_plain"), F.col("_listed"), F.col("_card")
    sale = F.when(card.isNotNull() & (plain.isNull() | (card < plain)), card).otherwise(plain)
    raw = F.try_variant_get(p, "$.promotions", "array<struct<id:string,name:string,start_date:string,end_date:string>>")
    promotions = F.coalesce(F.transform(raw, lambda x: F.struct(x["id"].alias("id"), F.coalesce(collapsed(x["name"]), F.lit("")).alias("name"), local_time(x["start_date"]).alias("start_at"), local_time(x["end_date"]).alias("end_at"))), F.array().cast("array<struct<id:string,name:string,start_at:string,end_at:string>>"))
    filled = lambda field: F.filter(F.transform("promotions", lambda x: x[field]), lambda t: t != "")
    prices = once(payloads, _name=clean(p, "name"), _slug=clean(p, "slug"), _image=clean(p, "thumbnail_image"), _plain=price(p, "sale_price"), _listed=price(p, "unit_price"), _card=price(p, "mcard_price"))
    rows = once(prices, _sale=sale).filter(F.col("_name").isNotNull() & F.col("_slug").isNotNull() & F.col("_sale").isNotNull() & _web(F.col("_image")))
    kinds = "array<struct<id:string,name:string,name_en:string,slug:string>>"
    tidy = lambda x, f: F.coalesce(collapsed(x[f]), F.lit("")).alias(f)
    categories = F.filter(F.try_variant_get(p, "$.categories", kinds), lambda x: x.isNotNull())
    categories = F.coalesce(F.transform(categories, lambda x: F.struct(x["id"].alias("id"), tidy(x, "name"), tidy(x, "name_en"), tidy(x, "slug"))), F.array().cast(kinds))
    rows = once(rows, categories=categories, promotions=promotions, sale_price=F.col("_sale"), original_price=F.when(listed > F.col("_sale"), listed))
    return rows.select(
        F.col("_name").alias("name"),
        F.concat(F.lit(MM_SITE + "/products/"), F.col("_slug")).alias("url"),
        F.col("_image").alias("image"),
        "sale_price",
        "original_price",
        discount_label(F.col("sale_price"), F.col("original_price")).alias("discount"),
        F.array_join(filled("name"), "; ").alias("promotion"),
        "promotions",
        "categories",
        clean(p, "sku").alias("sku"),
        clean(p, "id").alias("product_id"),
        F.coalesce(F.array_min(filled("start_at")), F.lit("")).alias("sale_start_at"),
        F.coalesce(F.array_max(filled("end_at")), F.lit("")).alias("sale_end_at"),
    )


#: Fields of a payload that hold promotion texts, in order; lists of promotions; the
#: fields that name one of them; and kinds that mark a promotion.
BHX_TEXTS = ("promotionText", "promotionTextFS", "textPromotion", "textPromtionNonBlue", "textPromtionNonBlueFS", "label", "promotion", "giftText", "gift_text")
BHX_LISTS = ("listCombo", "combos", "gifts", "giftProducts", "lstGift")
BHX_NAMES = ("name", "title", "label", "promotionText", "textPromotion", "textPromtionNonBlue", "description", "content")
BHX_KINDS = ("comboType", "productProType", "promotionType", "giftType")
BUY_TOGETHER, BUY_MANY, LISTED_PROMOTIONS = "Khuyến mãi mua kèm", "Khuyến mãi mua nhiều", 5
BHX_ENTRY = "array<struct<price:variant,sysPrice:variant,salePriceNonBlue:variant,discountPercent:variant,promotionText:variant,label:variant,isBuyTogether:variant,quantityCondition:variant>>"


def truthy(value: Column) -> Column:
    """Whether a VARIANT scalar is neither null, blank, zero nor false."""
    return F.coalesce(~F.lower(text_of(value)).isin("0", "0.0", "false"), F.lit(False))


def _filled(value: Column) -> Column:
    """Whether a VARIANT is an array or object with content."""
    return F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")) > 0, F.size(F.try_variant_get(value, "$", "map<string,variant>")) > 0, F.lit(False))


#: Fields by which a promotion without any text is described.
BHX_COMPACT = ("crmProgramId", "timeLineId", "maxQuantityOrder", "remainingQuantity", "startTime", "dueTime")


def _compact(value: Column) -> Column:
    """A promotion object's describing fields that are filled, in JSON with sorted keys; null if there are none."""
    at = lambda f: F.try_variant_get(value, f"$.{f}", "variant")
    empty = lambda v: F.coalesce(F.is_variant_null(v), F.lit(True)) | F.to_json(v).isin('""', "[]", "{}")
    text = lambda f: F.when(~empty(at(f)), F.concat(F.lit(f'"{f}": '), F.to_json(at(f))))
    filled = F.array_join(F.array_compact(F.array(*[text(f) for f in sorted(BHX_COMPACT)])), ", ")
    return F.when(filled != "", F.concat(F.lit("{"), filled, F.lit("}")))


def _promotion_name(value: Column) -> Column:
    """A promotion object's first text, else its describing fields, or the text itself."""
    return F.coalesce(*[text_of(F.try_variant_get(value, f"$.{n}", "variant")) for n in BHX_NAMES], text_of(value), _compact(value))


def bhx_offers(payloads: DataFrame) -> DataFrame:
    """The cheapest discounted price entry, else the cheapest, the first of equals; kept if discounted
    or promoted in any other way: a text, a list of promotions or campaigns, a popup, a kind, or a
    price entry for several items. A promotion without any text is named by its other fields."""
    p, c = F.col("payload"), F.col
    at = lambda field: F.try_variant_get(p, f"$.{field}", "variant")
    entries = F.coalesce(F.try_variant_get(p, "$.productPrices", BHX_ENTRY), F.array().cast(BHX_ENTRY))
    rows = once(with_lowered(payloads), entries=entries)
    priced = F.transform("entries", lambda e, i: F.struct(payload_price(e["price"]).alias("price"), i.alias("place"), payload_price(e["sysPrice"]).alias("listed"), *[text_of(e[f]).alias(f) for f in ("discountPercent", "promotionText", "label")], *[truthy(e[f]).alias(f) for f in ("isBuyTogether", "quantityCondition")]))
    rows = once(rows, prices=F.filter(priced, lambda e: e["price"].isNotNull()))
    rows = once(rows, chosen=F.coalesce(F.array_min(F.filter("prices", lambda e: e["listed"] > e["price"])), F.array_min("prices")))
    several = lambda f: F.slice(F.try_variant_get(p, f"$.{f}", "array<variant>"), 1, LISTED_PROMOTIONS)
    listed = [F.coalesce(several(f), F.when(at(f).isNotNull(), F.array(at(f))), F.array().cast("array<variant>")) for f in BHX_LISTS]
    rows = once(rows, listed=F.concat(*listed))
    chosen = [c("chosen.label"), c("chosen.promotionText"), c("chosen.discountPercent"), F.when(c("chosen.isBuyTogether"), BUY_TOGETHER), F.when(c("chosen.quantityCondition"), BUY_MANY)]
    texts = F.array_distinct(F.array_compact(F.concat(F.array(*[text_of(at(f)) for f in BHX_TEXTS], *chosen), F.transform("listed", _promotion_name))))
    cut = F.coalesce(c("chosen.listed") > c("chosen.price"), F.lit(False))
    of_entry = F.exists("entries", lambda e: truthy(e["isBuyTogether"]) | truthy(e["quantityCondition"]) | text_of(e["label"]).isNotNull() | text_of(e["promotionText"]).isNotNull() | payload_price(e["salePriceNonBlue"]).isNotNull())
    other = reduce(lambda a, b: a | b, [F.size("texts") > 0, *[_filled(at(f)) for f in (*BHX_LISTS, "lstCampaingInfo")], truthy(at("isShowPopupPromotion")), *[truthy(at(f)) for f in BHX_KINDS], F.coalesce(of_entry, F.lit(False))])
    v = lambda *names: first_text(c("f"), list(names))
    name, url = v("productName", "product_name", "name", "title", "displayName"), v("url", "productUrl", "product_url", "link", "href", "slug")
    campaigns = F.try_variant_get(p, "$.lstCampaingInfo", "array<struct<startTime:string,dueTime:string>>")
    times = lambda f: F.filter(F.transform(campaigns, lambda x: collapsed(x[f])), lambda t: t != "")
    rows = once(rows, texts=texts, cut=cut, name=name, link=url)
    kept = rows.filter(c("chosen").isNotNull() & c("name").isNotNull() & (c("cut") | other))
    return kept.select(
        "name",
        F.when(_web(c("link")), c("link")).otherwise(F.concat(F.lit(BHX_SITE), F.when(c("link").startswith("/"), "").otherwise("/"), c("link"))).alias("url"),
        v("image", "imageUrl", "image_url", "thumbnail", "picture", "avatar").alias("image"),
        c("chosen.price").alias("sale_price"),
        F.when(c("cut"), c("chosen.listed")).alias("original_price"),
        F.when(c("cut"), F.coalesce("chosen.discountPercent", discount_label(c("chosen.price"), c("chosen.listed"), sign=""))).otherwise("").alias("discount"),
        F.when(c("cut"), "category_sale").otherwise("category_promotion").alias("promotion_type"),
        F.array_join("texts", "; ").alias("promotion"),
        text_of(at("category.name")).alias("category_name"),
        text_of(at("brandName")).alias("brand"),
        v("unit", "unitName", "quantity").alias("unit"),
        text_of(at("productCode")).alias("sku"),
        text_of(at("id")).alias("product_id"),
        F.array_compact(F.transform(F.try_variant_get(p, "$.listCombo", "array<variant>"), _promotion_name)).alias("combos"),
        F.array_min(times("startTime")).alias("sale_start_at"),
        F.array_max(times("dueTime")).alias("sale_end_at"),
        F.lit("network_json").alias("source"),
    )


#: Fields of a product and the names under which payloads have them.
WINMART_TEXTS = {
    "branch_name": ("branchName", "storeName"),
    "brand_raw": ("brandName", "brand", "manufacturer"),
    "category_raw": ("category", "categoryName", "cateName"),
    "package_size_raw": ("packageSize", "size", "volume", "weight", "capacity"),
    "promotion_text_raw": ("promotionText", "promotion", "promoText", "description"),
    "promotion_start_date": ("promotionStartDate", "startDate"),
    "promotion_end_date": ("promotionEndDate", "endDate"),
    "availability_raw": ("availability", "stockStatus", "status", "inventoryStatus"),
    "image_url": ("imageUrl", "mediaUrl", "image", "thumbnail", "thumbnailUrl", "avatar"),
}
#: Names of prices, links and images outside price entries, and of parts of an image object.
BHX_SALE = ("salePrice", "sale_price", "discountPrice", "discount_price", "finalPrice", "price")
BHX_LISTED = ("originalPrice", "original_price", "oldPrice", "old_price", "listPrice", "marketPrice")
BHX_LINKS = ("url", "productUrl", "product_url", "link", "href", "slug")
BHX_IMAGES = ("image", "imageUrl", "image_url", "thumbnail", "picture", "avatar")
BHX_SIZES = ("url", "src", "large", "medium", "small")


def bhx_walk_offers(payloads: DataFrame) -> DataFrame:
    """Products that a walk over any payload finds: the price of the cheapest discounted entry, else of
    the cheapest, else one beside them; an image may be an object or a list. One without a price, a
    link and an image is no product."""
    p, c = F.col("payload"), F.col
    entries = F.coalesce(F.try_variant_get(p, "$.productPrices", BHX_ENTRY), F.array().cast(BHX_ENTRY))
    priced = F.transform("entries", lambda e, i: F.struct(payload_price(e["price"]).alias("price"), i.alias("place"), payload_price(e["sysPrice"]).alias("listed"), text_of(e["discountPercent"]).alias("discount")))
    rows = once(with_lowered(payloads), entries=entries)
    rows = once(rows, prices=F.filter(priced, lambda e: e["price"] > 0))
    rows = once(rows, chosen=F.coalesce(F.array_min(F.filter("prices", lambda e: e["listed"] > e["price"])), F.array_min("prices")))

    def first(names: tuple[str, ...]) -> Column:
        """The first field that isn't empty, of any kind."""
        values = [F.try_element_at(c("f"), F.lit(n.lower())) for n in names]
        return F.coalesce(*[F.when(~F.coalesce(F.is_variant_null(v), F.lit(True)) & (F.to_json(v) != '""'), v) for v in values])

    part = lambda value, names: F.coalesce(*[text_of(F.try_variant_get(value, f"$.{n}", "variant")) for n in names])
    names = {
        "name": ("productName", "product_name", "name", "title", "displayName"),
        "link": BHX_LINKS,
        "picture": BHX_IMAGES,
        "sale": BHX_SALE,
        "listed": BHX_LISTED,
        "discount": ("discount", "discountPercent", "discount_percent", "promotion"),
        "promotion": ("promotionText", "promotion_text", "campaign", "label"),
        "unit": ("unit", "unitName", "quantity"),
    }
    rows = once(rows.select("chosen", "f"), **{field: first(n) for field, n in names.items()})
    texts = ("name", "link", "discount", "promotion", "unit")
    rows = once(rows.withColumnsRenamed({f: f"_{f}" for f in texts}), head=F.try_variant_get("picture", "$[0]", "variant"), **{f: text_of(c(f"_{f}")) for f in texts})
    image = F.coalesce(text_of(c("picture")), part(c("picture"), BHX_SIZES), text_of(c("head")), part(c("head"), BHX_SIZES[:2]))
    kept = rows.filter(c("name").isNotNull() & (c("chosen").isNotNull() | c("sale").isNotNull() | c("link").isNotNull() | c("picture").isNotNull()))
    entry = c("chosen").isNotNull()
    return kept.select(
        "name",
        F.when(_web(c("link")), c("link")).otherwise(F.concat(F.lit(BHX_SITE), F.when(c("link").startswith("/"), "").otherwise("/"), c("link"))).alias("url"),
        image.alias("image"),
        F.when(entry, c("chosen.price")).otherwise(payload_price(c("sale"))).alias("sale_price"),
        F.when(entry, c("chosen.listed")).otherwise(payload_price(c("listed"))).alias("original_price"),
        F.coalesce("discount", c("chosen.discount"), F.lit("")).alias("discount"),
        F.coalesce("promotion", F.lit("")).alias("promotion"),
        "unit",
        F.lit("network_json").alias("source"),
    )


def winmart_offers(payloads: DataFrame) -> DataFrame:
    """Prices by case-insensitive names; a differing raw price stands for a missing listed one."""
    values = {
        "raw": ("price", "sellingPrice", "finalPrice", "retailPrice"),
        "promo": ("promoPrice", "salePrice", "discountPrice", "promotionPrice", "specialPrice"),
        "listed": ("listedPrice", "listPrice", "originalPrice", "oldPrice", "basePrice", "regularPrice"),
        "current": ("currentPrice",),
        "amount": ("discountAmount", "discount", "saveAmount"),
        "percent": ("discountPercent", "discountRate", "percentDiscount"),
    }
    rows = once(with_lowered(payloads), **{f"_{field}": first_value(F.col("f"), list(names)) for field, names in values.items()})
    rows = once(rows, **{field: money(F.col(f"_{field}")) for field in values})
    v = lambda *names: first_text(F.col("f"), list(names))
    raw, promo = F.col("raw"), F.col("promo")
    listed = F.coalesce("listed", F.when(promo.isNotNull() & (raw != promo), raw))
    zero = lambda x: F.when(x != 0, x)
    return rows.select(
        v("productId", "product_id", "id", "sku", "code", "itemId").alias("source_product_id"),
        v("productName", "product_name", "name", "title", "displayName").alias("product_name_raw"),
        v("unit", "uomName", "uom", "measureUnit").alias("unit_raw"),
        listed.alias("listed_price"),
        promo.alias("promo_price"),
        F.coalesce("current", zero(promo), zero(raw), listed).alias("current_price"),
        F.col("amount").alias("discount_amount"),
        F.col("percent").alias("discount_percent"),
        *[v(*names).alias(field) for field, names in WINMART_TEXTS.items()],
        "payload",
    )


def enriched(records: DataFrame, categories: DataFrame) -> DataFrame:
    """Discount flags, amounts and category context; the categories' size is checked before they are sent."""
    cut = F.coalesce(F.col("promo_price") < F.col("listed_price"), F.lit(False))
    amount = F.col("listed_price") - F.col("promo_price")
    return records.join(small_side(categories), "category_code", "left").withColumns(
        {"is_price_discount": cut, "is_on_promotion": cut, "discount_amount": F.when(cut, amount), "discount_percent": F.when(cut, F.round((amount / F.col("listed_price") * 100).cast("decimal(28,12)"), 2))}
    )


#: Columns of a store's context.
CONTEXT = ["store_code", "store_group_code", "address_context", "branch_name"]


def with_stock(records: DataFrame, quantity: str = "quantity") -> DataFrame:
    """Stock quantity and availability from a payload's quantity, where it has one."""
    given = F.nullif(F.col(quantity).cast("string"), F.lit(""))
    return records.withColumns({"stock_quantity": given, "availability_raw": F.when(given.isNotNull(), F.concat(F.lit("quantity="), given))})


def with_store_context(records: DataFrame, contexts: DataFrame, at: str = "observed_at") -> DataFrame:
    """Each record with the context that its retailer had at its time: the last one that began by then.

    contexts: retailer_id, valid_from and CONTEXT. A context lasts until the retailer's next one
    begins, and is listed for each day on which it holds, up to the last day of a record; records
    meet contexts by retailer and day, so a retailer with most of the rows is spread over its
    days. Before its first context a record has none; its own branch stays where a context names
    none. Of contexts that begin at once the greatest holds."""
    began = contexts.groupBy("retailer_id", "valid_from").agg(F.max(F.struct(*CONTEXT)).alias("context"))
    until = F.lead("valid_from").over(Window.partitionBy("retailer_id").orderBy("valid_from"))
    last = records.agg(F.max(F.col(at).cast("date")).alias("last_day"))
    spans = began.withColumn("valid_to", until).join(F.broadcast(last))
    first, end = F.col("valid_from").cast("date"), F.coalesce(F.col("valid_to").cast("date"), "last_day")
    days = spans.filter(first <= F.col("last_day")).withColumn("_day", F.explode(F.sequence(first, F.greatest(first, F.least(end, "last_day")))))
    days = days.select("retailer_id", "_day", "valid_from", "valid_to", "context")
    rows = records.withColumn("_day", F.col(at).cast("date"))
    met = rows.alias("r").join(
        small_side(days).alias("c"),
        (F.col("r.retailer_id") == F.col("c.retailer_id")) & (F.col("r._day") == F.col("c._day")) & (F.col(f"r.{at}") >= F.col("c.valid_from")) & (F.col("c.valid_to").isNull() | (F.col(f"r.{at}") < F.col("c.valid_to"))),
        "left",
    )
    own = [c for c in records.columns if c not in CONTEXT]
    branch = F.coalesce("c.context.branch_name", F.col("r.branch_name")) if "branch_name" in records.columns else F.col("c.context.branch_name")
    return met.select(*[F.col(f"r.{c}") for c in own], *[F.col(f"c.context.{c}") for c in CONTEXT[:3]], branch.alias("branch_name"))


def valid_offers(offers: DataFrame) -> DataFrame:
    """Positive price, web image, and a product page of two path parts on an allowed host."""
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    parts = F.filter(F.split(F.try_parse_url("url", F.lit("PATH")), "/"), lambda x: x != "")
    good = (F.col("sale_price") > 0) & F.col("image").rlike("^https?://[^/]+") & F.col("url").rlike("^https?://") & host.isin(*BHX_HOSTS) & (F.size(parts) == 2)
    return offers.filter(F.coalesce(good, F.lit(False)))


def slot_times(label: Column, day: Column) -> tuple[Column, Column]:
    """``10h - 12h`` on a day as two times; an end not after the start is on the next day."""
    hour = lambda k: F.nullif(F.regexp_extract(label, r"^\s*(\d{1,2})h?\s*-\s*(\d{1,2})h?\s*$", k), F.lit("")).try_cast("int")
    at = lambda h: day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.pmod(h, F.lit(24)))
    end = at(hour(2)) + F.make_dt_interval(F.when(hour(2) <= hour(1), 1).otherwise(0))
    return at(hour(1)), end


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Distinct links of stored pages, with item and category numbers where the link has them."""
    hrefs = F.explode(F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1)))
    links = pages.select(key, hrefs.alias("href")).distinct()
    number = lambda pattern: F.nullif(F.regexp_extract("href", pattern, 1), F.lit(""))
    return links.select(key, "href", number(r"--s(\d+)(?:[/?#]|$)").alias("item_no"), number(r"-i\.(\d+)").alias("category_id"))


def embedded_json(html: Column, script_id: str = "__NEXT_DATA__") -> Column:
    """The JSON of a page's data script, as VARIANT."""
    return F.try_parse_json(F.regexp_extract(html, rf'(?s)<script[^>]*id="{script_id}"[^>]*>(.*?)</script>', 1))


def card_prices(text: Column) -> tuple[Column, Column, Column]:
    """(sale, original, percent text) of a card: the least and, if it differs, the greatest price."""
    prices = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(\d[\d.,]*)\s*(?:₫|đ)"), F.lit(1)), digits_number), lambda x: x > 0)
    low, high = F.array_min(prices), F.array_max(prices)
    return low, F.when(high != low, high), F.regexp_extract(text, r"-?\d+%", 0)


def landing_counts(offers: DataFrame, category: str, written: DataFrame | None = None) -> DataFrame:
    """Per category: candidates, discounted ones, and the rows that were written, where those are given."""
    counts = offers.groupBy(category).agg(F.count("*").alias("candidates"), F.count_if(F.col("original_price") > F.col("sale_price")).alias("discounted"))
    if written is None:
        return counts
    kept = written.groupBy(F.col(category).alias("_category")).agg(F.count("*").alias("written"))
    return counts.join(kept, F.col(category).eqNullSafe(F.col("_category")), "left").select(category, "candidates", "discounted", F.coalesce("written", F.lit(0)).alias("written"))


def page_category(html: Column) -> Column:
    """The category that a page's data script describes; its fields are null where there is none."""
    at = lambda path: F.try_variant_get(embedded_json(html), f"$.props.pageProps.{path}", "string")
    names = {"category_code": "data.categoryCode", "category_name": "data.name", "category_description": "data.description", "category_image_url": "data.imageUrl", "slug": "slug"}
    return F.struct(*[at(path).alias(name) for name, path in names.items()])
