import copy
import json

import pytest

from shelfline.operators.contract import contract_report, validate_critical, validate_products

PRODUCT = {
    "sku": "1", "name": "Oat drink", "brandName": "FIELD", "urlSlugText": "oat-drink", "ageRestriction": None, "alcohol": None,
    "discontinued": False, "discontinuedNote": None, "notForSale": True, "notForSaleReason": None, "quantityMin": 1, "quantityMax": 99,
    "quantityInterval": 1, "quantityDefault": 1, "quantityUnit": "ea", "weightType": "0", "sellingSize": "1 L", "energyClass": None,
    "onSaleDateDisplay": None,
    "price": {
        "amount": 99, "amountRelevant": 99, "amountRelevantDisplay": "£0.99", "bottleDeposit": 0, "bottleDepositDisplay": "£0.00",
        "comparison": None, "comparisonDisplay": None, "currencyCode": "GBP", "currencySymbol": "£", "perUnit": None,
    },
    "countryExtensions": None,
    "categories": [{"id": "1", "name": "Drinks", "urlSlugText": "drinks"}],
    "assets": [{"url": "https://example.com/a", "maxWidth": 10, "maxHeight": 10.5, "mimeType": "image/png", "assetType": "FR", "alt": None}],
}
META = {"pagination": {"offset": 0, "limit": 30, "totalCount": 1, "more": True}, "facets": []}


def changed(**changes):
    doc = copy.deepcopy(PRODUCT)
    for path, value in changes.items():
        node, *rest = path.split("__")
        target = doc
        for step in rest:
            target, node = target[node], step
        if value is KeyError:
            del target[node]
        else:
            target[node] = value
    return doc


def check(spark, validate, *docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i int, json string")
    return [r["errors"] for r in validate(df).orderBy("i").collect()]


CASES = [
    ({}, []),
    ({"price": KeyError}, ['"price" is required']),
    ({"price__amountRelevantDisplay": "0.99"}, ['"price.amountRelevantDisplay" fails to match the money pattern']),
    ({"price__currencyCode": "EUR"}, ['"price.currencyCode" must be [GBP]']),
    ({"brandName": KeyError}, ['"brandName" is required']),
    ({"brandName": None}, ['"brandName" must not be null']),
    ({"name": ""}, ['"name" must be a non-empty string']),
    ({"sku": 5}, ['"sku" must be a non-empty string']),
    ({"quantityMax": 1.5}, ['"quantityMax" must be a positive integer']),
    ({"quantityMin": 0}, ['"quantityMin" must be a positive integer']),
    ({"discontinued": "no"}, ['"discontinued" must be a boolean']),
    ({"price": "99p"}, ['"price" must be an object']),
    ({"categories": {}}, ['"categories" must be an array']),
    ({"categories": []}, []),
    ({"colour": "red"}, ['"colour" is not allowed']),
    ({"price__tax": 1}, ['"price.tax" is not allowed']),
    ({"assets": [{"url": "u", "maxWidth": "wide", "maxHeight": 1, "mimeType": "m", "assetType": "t"}]}, ['"assets.maxWidth" must be a number']),
    ({"categories": [7]}, ['"categories" must be an object']),
]


def test_product_rules(spark):
    got = check(spark, validate_products, *[changed(**c) for c, _ in CASES])
    for (change, expected), errors in zip(CASES, got):
        assert errors == expected, change


def test_not_json(spark):
    assert check(spark, validate_products, "{oops", "[1]")[0] == ["not valid JSON"]


@pytest.mark.parametrize("change,bad", [({}, False), ({"brandName": KeyError}, True), ({"price__amountRelevantDisplay": "0.99"}, True), ({"price": KeyError}, True), ({"quantityMin": 0}, False)])
def test_critical_rules(spark, change, bad):
    assert bool(check(spark, validate_critical, changed(**change))[0]) == bad


def test_page_report(spark):
    broken = [changed(brandName=KeyError, name=KeyError, sku=KeyError, colour=1), changed(price=KeyError, weightType=KeyError)]
    pages = {
        "good": {"meta": META, "data": [PRODUCT, PRODUCT]},
        "no_meta": {"data": []},
        "empty": {"meta": META, "data": []},
        "broken": {"meta": META, "data": broken},
        "extra": {"meta": META, "data": [PRODUCT], "debug": 1},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in pages.items()], "page string, json string")
    got = {r["page"]: r for r in contract_report(df, "page").collect()}
    assert got["good"]["is_valid"] and got["good"]["report"] == []
    assert '"meta" is required' in got["no_meta"]["report"] and not got["no_meta"]["structure_valid"]
    assert not got["empty"]["structure_valid"] and "does not contain 1 required value(s)" in got["empty"]["report"][0]
    assert not got["broken"]["critical_fields_valid"] and got["broken"]["product_errors"] == 6
    assert got["broken"]["report"][-1] == "... and 1 more" and len(got["broken"]["report"]) == 6
    assert got["extra"]["critical_fields_valid"] and got["extra"]["report"] == ['"debug" is not allowed']


def test_pages_of_one_key_stay_apart(spark):
    rows = [("a", json.dumps({"meta": META, "data": [PRODUCT, 7, None]})), ("a", json.dumps({"meta": META, "data": [PRODUCT]})), ("a", "{"), (None, None)]
    df = spark.createDataFrame(rows, "page string, json string")
    got = sorted((str(r["page"]), r["products"], r["product_errors"], r["critical_errors"], "; ".join(r["report"])) for r in contract_report(df, "page").collect())
    broken = 'Product[1]: "value" must be an object; Product[2]: "value" must be an object'
    assert got == [("None", 0, 0, 0, "not valid JSON"), ("a", 0, 0, 0, "not valid JSON"), ("a", 1, 0, 0, ""), ("a", 3, 2, 2, broken)]
