"""Nested JSON: every object that looks like a product, and menus as flat categories.

A payload is walked in one pass inside its task, with a stack of its own, so neither the plan
nor the number of jobs follows the depth, and a deep payload costs no other row. Payloads are
read as text: a parsed VARIANT has its keys sorted, and the order of keys decides which of
equal entries is the last. JSON that Python's parser rejects, or nests too deep for it (far
beyond the thousand levels of a VARIANT), counts as empty.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys, in lower case, by which an object counts as a product.
PRODUCT_NAMES = {"name", "productname", "product_name", "title", "displayname"}
PRODUCT_IDS = {"id", "productid", "product_id", "sku", "code", "itemid", "item_id"}
#: Fields of a menu's nodes that hold its children, and paths of nodes that are categories.
CHILDREN, MENU_PATHS = ("childrens", "children"), ("GroupV2", "")

HIT = pa.schema([("row", pa.int64()), ("product", pa.string())])
NODE = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("id", pa.string()), ("name", pa.string()), ("url", pa.string()), ("parent_name", pa.string())])


def parsed(text: str | None) -> object:
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


@lru_cache(maxsize=4096)
def _of_product(names: tuple[str, ...]) -> bool:
    keys = {k.lower() for k in names}
    if not keys & PRODUCT_NAMES:
        return False
    return any("price" in k for k in keys) or (bool(keys & PRODUCT_IDS) and any("product" in k or "sku" in k for k in keys))


def looks_like_product(node: dict) -> bool:
    """A name, and a key with "price" in it, or an id beside a key with "product" or "sku" in it. Objects
    of one shape are judged once."""
    return _of_product(tuple(node))


def objects(value: object, stop: Callable[[dict], bool] | None = None) -> Iterator[dict]:
    """All objects inside ``value``, outer ones first, in the order of the text; not what is inside
    those at which ``stop`` says so."""
    stack = [value]
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            yield node
            if stop and stop(node):
                continue
            stack.extend(reversed(node.values()))
        elif isinstance(node, list):
            stack.extend(reversed(node))


def cleaned(value: object) -> str:
    """Text with white space collapsed; empty for null."""
    return "" if value is None else " ".join(str(value).split())


def menu_nodes(value: object) -> Iterator[tuple[str, str, str, str]]:
    """(id, name, url, parent's name) of a menu's categories; a node's children come before its other fields."""
    stack = [(value, "")]
    while stack:
        node, parent = stack.pop()
        if isinstance(node, list):
            stack += [(child, parent) for child in reversed(node)]
        elif isinstance(node, dict):
            url, name = cleaned(node.get("url")), cleaned(node.get("name"))
            if url and name and cleaned(node.get("path")) in MENU_PATHS:
                yield cleaned(node.get("id")), name, url.strip("/"), parent
            children = next((node[f] for f in CHILDREN if node.get(f)), None)
            inside = list(children) if isinstance(children, list) else []
            inside += [v for k, v in node.items() if k not in CHILDREN and isinstance(v, (list, dict))]
            stack += [(child, name or parent) for child in reversed(inside)]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def product_walk(rows: DataFrame, json_text: str = "line", outermost: bool = False) -> DataFrame:
    """``product``: every nested object that looks like a product, at any depth, distinct by content
    (as JSON with sorted keys); only the outermost ones if asked."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, seen = [], set()
            for k, text in enumerate(batch[0]):
                for node in objects(parsed(text.as_py()), looks_like_product if outermost else None):
                    if looks_like_product(node) and (own := json.dumps(node, sort_keys=True, ensure_ascii=False)) not in seen:
                        seen.add(own)
                        found.append((k, own))
            yield _batch(HIT, found)

    hits = rows.select(json_text).mapInArrow(walk, "row long, product string")
    return hits.select(F.to_json(F.parse_json("product")).alias("product")).distinct()


def menu_categories(payloads: DataFrame, key: str, json_text: str = "line") -> DataFrame:
    """Categories of nested menus: key, id, name, url, parent_name; of equal urls the last in the
    order of the menu. An empty id is null."""
    kind = dict(payloads.dtypes)[key]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for k, text in enumerate(batch[1]):
                last: dict[str, tuple] = {}
                for place, (own, name, url, parent) in enumerate(menu_nodes(parsed(text.as_py()))):
                    last[url] = (place, own or None, name, url, parent)
                found += last.values()
                rows += [k] * len(last)
            nodes = _batch(NODE, [(k, *n) for k, n in zip(rows, found)])
            yield pa.RecordBatch.from_arrays([batch[0].take(nodes["row"]), *nodes.columns[1:]], names=["_key", *NODE.names[1:]])

    nodes = payloads.select(key, json_text).mapInArrow(walk, f"_key {kind}, place long, id string, name string, url string, parent_name string")
    last = F.max_by(F.struct("id", "name", "parent_name"), F.struct("place", "name", "id", "parent_name")).alias("last")
    return nodes.groupBy("_key", "url").agg(last).select(F.col("_key").alias(key), "last.id", "last.name", "url", "last.parent_name")
