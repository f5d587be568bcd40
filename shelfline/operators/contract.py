"""Contract checks on product payloads held as JSON text.

The text is parsed once into a VARIANT, a row per product, and split into plain struct columns;
every rule is a column expression on these and the failed ones are kept as an array of messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The product payload. (field, kind, required, nullable)
PRODUCT_FIELDS = [
    ("sku", "string", True, False),
    ("name", "string", True, False),
    ("brandName", "string", True, False),
    ("urlSlugText", "string", True, False),
    ("ageRestriction", "string", False, True),
    ("alcohol", "boolean", False, True),
    ("discontinued", "boolean", True, False),
    ("discontinuedNote", "string", False, True),
    ("notForSale", "boolean", True, False),
    ("notForSaleReason", "string", False, True),
    ("quantityMin", "positive", True, False),
    ("quantityMax", "positive", True, False),
    ("quantityInterval", "positive", True, False),
    ("quantityDefault", "positive", True, False),
    ("quantityUnit", "string", True, False),
    ("weightType", "string", True, False),
    ("sellingSize", "string", True, False),
    ("energyClass", "string", False, True),
    ("onSaleDateDisplay", "string", False, True),
    ("price", "object", True, False),
    ("countryExtensions", "any", False, True),
    ("categories", "array", True, False),
    ("assets", "array", True, False),
]
PRICE_FIELDS = [
    ("amount", "number", True, False),
    ("amountRelevant", "number", True, False),
    ("amountRelevantDisplay", "money", True, False),
    ("bottleDeposit", "number", True, False),
    ("bottleDepositDisplay", "money", True, False),
    ("comparison", "number", True, True),
    ("comparisonDisplay", "string", True, True),
    ("currencyCode", "=GBP", True, False),
    ("currencySymbol", "=£", True, False),
    ("perUnit", "string", False, True),
    ("perUnitDisplay", "string", False, True),
    ("wasPriceDisplay", "string", False, True),
    ("additionalInfo", "string", False, True),
]
CATEGORY_FIELDS = [("id", "string", True, False), ("name", "string", True, False), ("urlSlugText", "string", True, False)]
ASSET_FIELDS = [
    ("url", "string", True, False),
    ("maxWidth", "number", True, False),
    ("maxHeight", "number", True, False),
    ("mimeType", "string", True, False),
    ("assetType", "string", True, False),
    ("alt", "string", False, True),
    ("displayName", "string", False, True),
]
CRITICAL_FIELDS = [("sku", "string"), ("name", "string"), ("brandName", "string"), ("sellingSize", "string")]
MONEY_PATTERN = r"^£\d+\.\d{2}$"


Field = tuple[str, str, bool, bool]


def _struct_type(fields: list[Field]) -> str:
    return "struct<" + ",".join(f"`{name}`:variant" for name, *_ in fields) + ">"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _kind_error(value: Column, shape: Column, kind: str, label: str) -> Column:
    """Message when a present, non-null value is not of its kind."""
    if kind == "any":
        return F.lit(None).cast("string")
    if kind == "string":
        return F.when((shape != "STRING") | (_text(value) == ""), f'"{label}" must be a non-empty string')
    if kind == "boolean":
        return F.when(shape != "BOOLEAN", f'"{label}" must be a boolean')
    if kind == "number":
        return F.when((shape == "BOOLEAN") | _number(value).isNull(), f'"{label}" must be a number')
    if kind == "positive":
        number = _number(value)
        whole = (shape != "BOOLEAN") & (number > 0) & (number == F.floor(number))
        return F.when(~F.coalesce(whole, F.lit(False)), f'"{label}" must be a positive integer')
    if kind == "money":
        return F.when((shape != "STRING") | ~F.coalesce(_text(value).rlike(MONEY_PATTERN), F.lit(False)), f'"{label}" fails to match the money pattern')
    if kind == "object":
        return F.when(~shape.startswith("OBJECT"), f'"{label}" must be an object')
    if kind == "array":
        return F.when(~shape.startswith("ARRAY"), f'"{label}" must be an array')
    wanted = kind.removeprefix("=")
    return F.when(F.coalesce(_text(value), F.lit("")) != wanted, f'"{label}" must be [{wanted}]')


def _rule(fields: Column, prefix: str, field: Field) -> Column:
    name, kind, required, nullable = field
    label, value = f"{prefix}{name}", fields[name]
    absent = F.lit(f'"{label}" is required') if required else F.lit(None).cast("string")
    null = F.lit(None).cast("string") if nullable else F.lit(f'"{label}" must not be null')
    shape = F.schema_of_variant(value)
    return F.when(value.isNull(), absent).when(F.is_variant_null(value), null).otherwise(_kind_error(value, shape, kind, label))


def _unknown(keys: Column, prefix: str, fields: list[Field]) -> Column:
    known = F.array(*[F.lit(f[0]) for f in fields])
    return F.transform(
        F.coalesce(F.array_except(keys, known), F.array().cast("array<string>")),
        lambda k: F.concat(F.lit(f'"{prefix}'), k, F.lit('" is not allowed')),
    )


def _object_errors(fields: Column, keys: Column, prefix: str, rules: list[Field]) -> Column:
    found = F.array_compact(F.array(*[_rule(fields, prefix, f) for f in rules]))
    label = prefix.rstrip(".") or "value"
    broken = F.array(F.lit(f'"{label}" must be an object'))
    return F.when(fields.isNull(), broken).otherwise(F.concat(found, _unknown(keys, prefix, rules)))


_NONE = "array<string>"


def _unpacked(df: DataFrame, product: str) -> DataFrame:
    """A product variant split into field structs and key lists, level by level.

    Each level is one cast per object, stored as a plain column, so the rules below
    read struct fields in generated code and never walk the variant again.
    """

    def keys(of: Column) -> Column:
        return F.map_keys(F.try_variant_get(of, "$", "map<string,variant>"))

    df = df.withColumns({"_p": F.try_variant_get(product, "$", _struct_type(PRODUCT_FIELDS)), "_pk": keys(F.col(product))})
    return df.withColumns({
        "_price": F.try_variant_get("_p.price", "$", _struct_type(PRICE_FIELDS)),
        "_pricek": keys(F.col("_p.price")),
        "_cat": F.try_variant_get("_p.categories", "$", f"array<{_struct_type(CATEGORY_FIELDS)}>"),
        "_catm": F.try_variant_get("_p.categories", "$", "array<map<string,variant>>"),
        "_asset": F.try_variant_get("_p.assets", "$", f"array<{_struct_type(ASSET_FIELDS)}>"),
        "_assetm": F.try_variant_get("_p.assets", "$", "array<map<string,variant>>"),
    })


_WORK = ["_v", "_p", "_pk", "_price", "_pricek", "_cat", "_catm", "_asset", "_assetm"]


def _list_errors(items: str, maps: str, field: str, rules: list[Field]) -> Column:
    checked = F.flatten(F.transform(items, lambda m, j: _object_errors(m, F.map_keys(F.get(maps, j)), f"{field}.", rules)))
    return F.coalesce(checked, F.array().cast(_NONE))


def _product_errors() -> Column:
    """All structural errors of the row's product."""
    price = F.col("_price")
    inside = F.when(price.isNotNull(), _object_errors(price, F.col("_pricek"), "price.", PRICE_FIELDS)).otherwise(F.array().cast(_NONE))
    return F.concat(
        _object_errors(F.col("_p"), F.col("_pk"), "", PRODUCT_FIELDS),
        inside,
        _list_errors("_cat", "_catm", "categories", CATEGORY_FIELDS),
        _list_errors("_asset", "_assetm", "assets", ASSET_FIELDS),
    )


def _critical_errors() -> Column:
    """The row's errors in the five fields the ingest depends on."""
    p, price = F.col("_p"), F.col("_price")
    rules = [_rule(p, "", (n, k, True, False)) for n, k in CRITICAL_FIELDS]
    rules.append(_rule(p, "", ("price", "object", True, False)))
    rules.append(F.when(price.isNotNull(), _rule(price, "price.", ("amountRelevantDisplay", "money", True, False))))
    return F.when(p.isNull(), F.array(F.lit('"value" must be an object'))).otherwise(F.array_compact(F.array(*rules)))


def _judged(products: DataFrame, column: str, errors: Column) -> DataFrame:
    broken = F.array(F.lit("not valid JSON"))
    return (
        _unpacked(products.withColumn("_v", F.try_parse_json(column)), "_v")
        .withColumn("errors", F.when(F.col("_v").isNull(), broken).otherwise(errors))
        .drop(*_WORK)
        .withColumn("is_valid", F.size("errors") == 0)
    )


def validate_products(products: DataFrame, column: str = "json") -> DataFrame:
    """Full structural check of each product document; adds ``errors`` and ``is_valid``."""
    return _judged(products, column, _product_errors())


def validate_critical(products: DataFrame, column: str = "json") -> DataFrame:
    return _judged(products, column, _critical_errors())


def _page_errors(page: Column) -> Column:
    """Envelope: pagination numbers and a non-empty product array."""
    paging = F.try_variant_get(page, "$.meta.pagination", "variant")
    whole = lambda f, low: F.coalesce(
        (F.try_variant_get(paging, f"$.{f}", "double") >= low)
        & (F.try_variant_get(paging, f"$.{f}", "double") == F.floor(F.try_variant_get(paging, f"$.{f}", "double"))),
        F.lit(False),
    )
    data = F.try_variant_get(page, "$.data", "array<variant>")
    keys = F.map_keys(F.try_variant_get(page, "$", "map<string,variant>"))
    extra = F.transform(
        F.coalesce(F.array_except(keys, F.array(F.lit("meta"), F.lit("data"))), F.array().cast("array<string>")),
        lambda k: F.concat(F.lit('"'), k, F.lit('" is not allowed')),
    )
    fixed = F.array_compact(
        F.array(
            F.when(F.try_variant_get(page, "$.meta", "variant").isNull(), '"meta" is required').when(paging.isNull(), '"meta.pagination" is required'),
            F.when(paging.isNotNull() & ~whole("offset", 0), '"meta.pagination.offset" must be a whole number'),
            F.when(paging.isNotNull() & ~whole("limit", 1), '"meta.pagination.limit" must be a positive integer'),
            F.when(paging.isNotNull() & ~whole("totalCount", 0), '"meta.pagination.totalCount" must be a whole number'),
            F.when(data.isNull(), '"data" is required').when(F.size(data) == 0, '"data" does not contain 1 required value(s)'),
        )
    )
    return F.concat(fixed, extra)


def contract_report(pages: DataFrame, key: str, column: str = "json", shown: int = 5) -> DataFrame:
    """Per page: structure and critical verdicts, the first product errors and how many more there are.

    A page's products become rows, so that the rules run on plain columns; then its counts and first errors, not its
    text, are brought together. Pages that share a key stay apart.
    """
    none = F.array().cast(_NONE)
    members = F.try_variant_get(F.col("_v"), "$.data", "array<variant>")
    parsed = pages.withColumn("_v", F.try_parse_json(column)).select(
        F.col(key).alias("_key"), "_v", F.monotonically_increasing_id().alias("_row"),
        F.when(F.col("_v").isNull(), F.array(F.lit("not valid JSON"))).otherwise(_page_errors(F.col("_v"))).alias("_page"),
    )
    products = parsed.select("_key", "_row", "_page", F.posexplode_outer(members).alias("_i", "_m"))
    present = F.col("_i").isNotNull()
    name = F.concat(F.lit("Product["), F.col("_i").cast("string"), F.lit("]: "))
    judged = (
        _unpacked(products, "_m")
        .select(
            "_key", "_row", "_page", "_i",
            F.when(present, _product_errors()).otherwise(none).alias("_errors"),
            F.when(present, F.size(_critical_errors())).otherwise(0).alias("_critical"),
        )
        .withColumn("_first", F.transform(F.slice("_errors", 1, shown), lambda e: F.concat(name, e)))
    )
    failed = F.when(F.size("_errors") > 0, F.struct("_i", "_first"))
    page = judged.groupBy("_key", "_row", "_page").agg(
        F.count("_i").cast("int").alias("products"),
        F.sum(F.size("_errors")).cast("int").alias("product_errors"),
        F.sum("_critical").cast("int").alias("critical_errors"),
        F.array_sort(F.collect_list(failed)).alias("_failed"),
    )
    more = F.col("product_errors") - shown
    tail = F.when(more > 0, F.array(F.concat(F.lit("... and "), more.cast("string"), F.lit(" more")))).otherwise(none)
    structure = (F.size("_page") == 0) & (F.col("product_errors") == 0)
    critical = F.col("critical_errors") == 0
    return page.select(
        F.col("_key").alias(key),
        (structure & critical).alias("is_valid"),
        structure.alias("structure_valid"),
        critical.alias("critical_fields_valid"),
        "products",
        "product_errors",
        "critical_errors",
        F.concat(F.col("_page"), F.slice(F.flatten(F.transform("_failed", lambda p: p["_first"])), 1, shown), tail).alias("report"),
    )
