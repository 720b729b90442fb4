"""Record validation as Columns (VAL-01 .. VAL-10).

A rule is a named boolean Column (true = passes). ``validate`` splits a frame
into valid rows and rejects carrying the names of the rules they broke; nested
rules use higher-order functions over ``items`` / ``sellers`` — no Python UDF,
no explode. A failure anywhere inside a product rejects the whole product, as
in the reference.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import blank, clean_barcode, digits_only, force_https


def _ok(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    checks = F.array(*[F.when(~_ok(r), F.lit(n)) for n, r in rules.items()])
    tagged = df.withColumn("_failed", F.filter(checks, lambda x: x.isNotNull()))
    valid = tagged.where(F.size("_failed") == 0).drop("_failed")
    rejects = tagged.where(F.size("_failed") > 0).withColumnRenamed("_failed", "failed_rules")
    return valid, rejects


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One aggregate pass: rows checked and failures per rule (long format)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(~_ok(r)).alias(n) for n, r in rules.items()]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules]))
    return wide.select(F.col("_rows").alias("checked"), stack.alias("r")).select(
        "r.rule", "checked", "r.failures")


# ------------------------------------------------------------------ nested product
def _offer(s):
    return s["commertialOffer"]


def _fields(kind) -> list[str]:
    """Field names at a struct, or of an array's structs."""
    kind = getattr(kind, "elementType", kind)
    return kind.fieldNames() if hasattr(kind, "fieldNames") else []


def _kind(df: DataFrame, *path: str):
    """The type at a path of field names through structs and arrays; None where it ends."""
    kind = df.schema
    for name in path:
        kind = getattr(kind, "elementType", kind)
        if name not in _fields(kind):
            return None
        kind = kind[name].dataType
    return kind


def _not_negative(c) -> Column:
    return c.isNull() | (c >= 0)


def offer_checks(o, fields: list[str] | None = None) -> dict[str, Column]:
    """VAL-01: Price > 0; quantity >= 0; list price (NULL -> price) and price without discount
    not below the price; list price, price without discount, reward and tax not negative.
    ``fields``: those the offers have (all if None)."""
    out = {
        "Price": o["Price"] > 0,
        "AvailableQuantity": F.coalesce(o["AvailableQuantity"], F.lit(0)) >= 0,
        "ListPrice": _not_negative(o["ListPrice"]) & (F.coalesce(o["ListPrice"], o["Price"]) >= o["Price"]),
    }
    if fields is None or "PriceWithoutDiscount" in fields:
        w = o["PriceWithoutDiscount"]
        out["PriceWithoutDiscount"] = _not_negative(w) & (w.isNull() | (w >= o["Price"]))
    for name in ("RewardValue", "Tax"):
        if fields is None or name in fields:
            out[name] = _not_negative(o[name])
    return out


def _all(checks: Mapping[str, Column]) -> Column:
    ok = F.lit(True)
    for c in checks.values():
        ok = ok & _ok(c)
    return ok


def offer_ok(o, fields: list[str] | None = None) -> Column:
    return _all(offer_checks(o, fields))


def promotion_checks(p) -> dict[str, Column]:
    """VAL-02: discountValue >= 0; discountPercentage within [0, 100]; either may be absent."""
    return {"discountValue": _not_negative(p["discountValue"]),
            "discountPercentage": p["discountPercentage"].isNull() | p["discountPercentage"].between(0, 100)}


def promotion_ok(p) -> Column:
    return _all(promotion_checks(p))


def image_checks(im) -> dict[str, Column]:
    """VAL-05: the address is there and not blank."""
    return {"imageUrl": ~blank(im["imageUrl"])}


def _list(c) -> Column:
    return F.coalesce(c, F.array())


def nested_rejects(df: DataFrame, keep: list[str], path: list[str], label: str, checks, on: str | None = None) -> DataFrame:
    """One row per broken rule of an element inside nested arrays.

    ``path``: the arrays from the outside in, each named from the element around it (a dot goes
    through a struct). ``checks`` gives the rules of an element, or of its struct ``on``. Rows have
    ``keep``, the element's place at each level (``<array>_pos``, from 1), its ``label`` field
    and the rule's name. Only broken rules leave the row: nothing is exploded for elements
    in order.
    """
    def get(c: Column, name: str) -> Column:
        for part in name.split("."):
            c = c[part]
        return c

    def level(arr: Column, steps: list[str], places: list[Column]) -> Column:
        def one(x, i):
            here = [*places, (i + 1).cast("int").alias(steps[0].split(".")[-1] + "_pos")]
            if steps[1:]:
                return level(get(x, steps[1]), steps[1:], here)
            rules = checks(get(x, on) if on else x)
            broken = F.filter(F.array(*[F.when(~_ok(c), F.lit(n)) for n, c in rules.items()]), lambda r: r.isNotNull())
            return F.transform(broken, lambda r: F.struct(*here, x[label].cast("string").alias(label), r.alias("rule")))
        return F.flatten(F.transform(_list(arr), one))

    return df.select(*keep, F.explode(level(F.col(path[0]), path, [])).alias("_x")).select(*keep, "_x.*")


def offer_rejects(df: DataFrame, keep: list[str]) -> DataFrame:
    """VAL-01 with positions: item, seller and the rule its offer breaks."""
    fields = _fields(_kind(df, "items", "sellers", "commertialOffer"))
    return nested_rejects(df, keep, ["items", "sellers"], "sellerId", lambda o: offer_checks(o, fields), on="commertialOffer")


def promotion_rejects(df: DataFrame, keep: list[str]) -> DataFrame:
    """VAL-02 with positions: item, seller, promotion and the rule it breaks."""
    return nested_rejects(df, keep, ["items", "sellers", "commertialOffer.Promotions"], "promotionId", promotion_checks)


def image_rejects(df: DataFrame, keep: list[str]) -> DataFrame:
    """VAL-05 with positions: item, image and the rule it breaks."""
    return nested_rejects(df, keep, ["items", "images"], "imageId", image_checks)


def product_rules(df: DataFrame) -> dict[str, Column]:
    """Rules of a whole product; those on promotions and images where the shape has them."""
    items = _list(F.col("items"))
    fields = _fields(_kind(df, "items", "sellers", "commertialOffer"))
    sellers = lambda ok: F.forall(items, lambda i: F.forall(_list(i["sellers"]), ok))
    rules = {
        "VAL-06 productId": ~blank(F.col("productId")),
        "VAL-06 productName": ~blank(F.col("productName")) & (F.length(F.trim("productName")) <= 500),
        "VAL-06 link": ~blank(F.col("link")),
        "VAL-06 items": F.size(items) >= 1,
        "VAL-04 item": F.forall(items, lambda i: ~blank(i["itemId"]) & (F.size(_list(i["sellers"])) >= 1)),
        "VAL-03 seller": sellers(lambda s: ~blank(s["sellerId"])),
        "VAL-01 offer": sellers(lambda s: offer_ok(_offer(s), fields)),
    }
    if "Promotions" in fields:
        rules["VAL-02 promotion"] = sellers(lambda s: F.forall(_list(_offer(s)["Promotions"]), promotion_ok))
    if "images" in _fields(_kind(df, "items")):
        rules["VAL-05 image"] = F.forall(items, lambda i: image_rules(i["images"]))
    return rules


def normalize_product(df: DataFrame) -> DataFrame:
    """Normalisations applied to valid records: trimmed name, https link, list
    price defaulting to the price, barcode cleaned (VAL-04/05/06)."""
    def fix_item(i):
        return i.withField("ean", clean_barcode(i["ean"])).withField(
            "sellers", F.transform(i["sellers"], lambda s: s.withField(
                "commertialOffer", _offer(s).withField(
                    "ListPrice", F.coalesce(_offer(s)["ListPrice"], _offer(s)["Price"])))))
    return (df.withColumn("productName", F.trim("productName"))
              .withColumn("link", force_https(F.col("link")))
              .withColumn("items", F.transform("items", fix_item)))


def image_rules(images: Column) -> Column:
    """VAL-05: every image has a non-blank url."""
    return F.forall(_list(images), lambda im: _all(image_checks(im)))


def normalize_images(images: Column) -> Column:
    return F.transform(images, lambda im: im.withField("imageUrl", force_https(im["imageUrl"])))


def category_rules() -> dict[str, Column]:
    """VAL-07: category node id > 0 and non-blank name (flattened tree rows)."""
    return {"VAL-07 id": F.col("id") > 0, "VAL-07 name": ~blank(F.col("name"))}


NODE = "array<struct<id: long, name: string, hasChildren: boolean, children: string>>"


def flatten_categories(trees: DataFrame, keep: list[str], json: str = "json") -> DataFrame:
    """The nodes of category trees of any depth: ``keep``, depth (from 1), path (names from the
    root down, ' > ' between), id, name and whether the node has children.

    A tree is JSON text. Each round parses one level, leaving the children as text for the
    next, until no node has any; a level is written, so the plan doesn't grow with the
    depth and a lost executor costs no level above."""
    level = trees.select(*keep, F.lit("").alias("_above"), F.col(json).alias("_json"))
    out, depth = None, 0
    while True:
        depth += 1
        nodes = level.select(*keep, "_above", F.explode(F.from_json("_json", NODE)).alias("n"))
        name = F.coalesce("n.name", F.lit(""))
        nodes = written(nodes.select(
            *keep, F.lit(depth).alias("depth"), F.when(F.col("_above") == "", name).otherwise(F.concat("_above", F.lit(" > "), name)).alias("path"),
            "n.id", "n.name", "n.hasChildren", F.col("n.children").alias("_json")), "categories")
        out = nodes.drop("_json") if out is None else out.unionByName(nodes.drop("_json"))
        level = nodes.where("_json is not null and _json <> '[]'").select(*keep, F.col("path").alias("_above"), "_json")
        if level.limit(1).isEmpty():
            return out


# ------------------------------------------------------------------ flat product
def flat_product_rules() -> dict[str, Column]:
    """VAL-08 (after ``normalize_flat``): ids and names present, price > 0,
    list price >= price, stock >= 0."""
    return {
        "VAL-08 productId": ~blank(F.col("productId")),
        "VAL-08 productName": ~blank(F.col("productName")),
        "VAL-08 price": F.col("price") > 0,
        "VAL-08 listPrice": F.col("listPrice").isNull() | (F.col("listPrice") >= F.col("price")),
        "VAL-08 stock": F.col("stock").isNull() | (F.col("stock") >= 0),
    }


def normalize_flat(df: DataFrame) -> DataFrame:
    """Strip strings, coerce numbers from text, barcode digits or NULL, https image."""
    e = digits_only(F.col("ean"))
    return df.select(
        F.trim(F.col("productId").cast("string")).alias("productId"),
        F.trim("productName").alias("productName"),
        F.col("price").cast("string").try_cast("double").alias("price"),
        F.col("listPrice").cast("string").try_cast("double").alias("listPrice"),
        F.col("available").cast("boolean").alias("available"),
        F.col("stock").cast("string").try_cast("double").cast("int").alias("stock"),
        F.trim("brand").alias("brand"),
        F.when(F.length(e) > 0, e).alias("ean"),
        force_https(F.col("imageUrl")).alias("imageUrl"),
        force_https(F.col("productUrl")).alias("productUrl"),
        F.trim("storeId").alias("storeId"),
        "scrapedAt",
        F.coalesce(F.col("platform"), F.lit("osuper")).alias("platform"),
    )


# ------------------------------------------------------------------ reference record
def reference_rules() -> dict[str, Column]:
    """VAL-09: barcode length 8, 13 or 14."""
    return {"VAL-09 code": F.length("code").isin(8, 13, 14)}


def normalize_reference(df: DataFrame) -> DataFrame:
    g = F.lower(F.trim("nutriscore_grade"))
    return df.withColumn("nutriscore_grade", F.when(g.isin("a", "b", "c", "d", "e"), g))


# ------------------------------------------------------------------ run volume
def run_volume(bronze: DataFrame, min_rows: int = 500) -> DataFrame:
    """VAL-10: rows per run, LOW VOLUME below ``min_rows``."""
    return (bronze.groupBy(F.col("_metadata_run_id").alias("run_id"), F.col("_metadata_supermarket").alias("store"))
                  .agg(F.count(F.lit(1)).alias("rows"))
                  .withColumn("status", F.when(F.col("rows") >= min_rows, "OK").otherwise("LOW VOLUME")))
