import pytest

from cashweave.operators import upserts
from cashweave.operators.existence import exists_in
from cashweave.operators.categorise import REPAYMENT_VARIANTS, rules_frame
from small import bridge, expected, rows, sales

SKU = "sku_id string, merchant_id string"


def _skus(spark, *pairs):
    return spark.createDataFrame(list(pairs), SKU)


def _people(spark, *names):
    return upserts.merchant_rows(spark.createDataFrame([(n,) for n in names], "merchant_name string"))


def test_insert_ignore_keeps_existing(spark):
    old, new = _skus(spark, ("A", "m")), _skus(spark, ("A", "n"), ("B", "z"), ("B", "y"))
    assert rows(upserts.insert_ignore(old, new, ["sku_id"])) == [("A", "m"), ("B", "y")]


def test_upsert_takes_new(spark):
    old, new = _skus(spark, ("A", "m"), ("C", "c")), _skus(spark, ("A", "n"), ("A", "n"), ("B", "b"))
    assert rows(upserts.upsert(old, new, ["sku_id"])) == [("A", "n"), ("B", "b"), ("C", "c")]
    with pytest.raises(ValueError, match="two different new rows"):
        upserts.upsert(old, _skus(spark, ("A", "n"), ("A", "o")), ["sku_id"])


def test_replace_by_scope(spark):
    old = bridge(spark, (None, "A", "V1", "m"), ("N", "B", "V2", "m"), (None, None, "V3", "m"))
    new = bridge(spark, (None, "A", "V9", "m"), ("", "A", "V9", "m"), ("N", "A", "V9", "m"))
    found = upserts.replace_by(old, new, ["sku_id"], ["note_id", "va_number", "sku_id"])
    assert rows(found, "note_id", "sku_id", "va_number") == [
        (None, None, "V3"),
        (None, "A", "V9"),
        ("N", "A", "V9"),
        ("N", "B", "V2"),
    ]


def test_merchants_come_from_sales(spark):
    raw = sales(spark, (" ABC ", "S", "1"), ("ABC", "T", "1"), (" ", "U", "1"), (None, "V", "1"))
    found = upserts.upsert_merchants(_people(spark, "Old  Co"), raw)
    assert rows(found, "merchant_name", "merchant_name_norm") == [("ABC", "abc"), ("Old  Co", "old co")]
    again = upserts.upsert_merchants(found, raw)
    assert rows(again) == rows(found)


def test_skus_find_their_merchant_by_lower_case(spark):
    people = _people(spark, "Abc")
    key = people.first()["merchant_id"]
    raw = sales(spark, ("aBC", " S ", "1"), ("who", "T", "1"), ("Abc", "U", "1"))
    found = upserts.upsert_skus(_skus(spark, ("U", "kept")), people, raw)
    assert rows(found) == [("S", key), ("U", "kept")]
    assert upserts.sku_coverage(found, raw).first().asDict() == {
        "ref_sku_count": 2,
        "sales_sku_count": 3,
    }


def test_rules_are_added_once(spark):
    rules = rules_frame(spark)
    once = upserts.add_rules(rules, rules_frame(spark, REPAYMENT_VARIANTS))
    assert once.count() == 20
    assert upserts.add_rules(once, rules_frame(spark, REPAYMENT_VARIANTS)).count() == 20


def test_hand_written_bridge_rows(spark):
    people = _people(spark, "ABC")
    empty = bridge(spark)
    literals = [("44", "S", "V1"), ("44", "S", "V2")]
    once = upserts.add_bridge_rows(empty, people, "ABC", literals)
    assert rows(once, "note_id", "sku_id", "va_number") == [("44", "S", "V1"), ("44", "S", "V2")]
    assert upserts.add_bridge_rows(once, people, "ABC", literals).count() == 2
    assert upserts.add_bridge_rows(empty, people, "nobody", literals).count() == 0


def _batch(spark, *triples):
    return spark.createDataFrame(list(triples), "note_id string, sku_id string, va_number string")


def test_mapping_load(spark):
    people = _people(spark, "ABC", "XYZ")
    abc, xyz = (r["merchant_id"] for r in people.orderBy("merchant_name").collect())
    batch = _batch(spark, ("", " S ", " V1 "), ("", "S", "V1"), (None, "T", "V2"), ("", "", "V3"), ("", "U", " "))
    raw_sales = sales(spark, ("abc", "S", "1"))
    raw_expected = expected(spark, {"merchant": "ABC ", "sku_id": "S"}, {"merchant": "xyz", "sku_id": "T"})
    old = bridge(spark, (None, "S", "OLD", abc), (None, "Z", "KEEP", abc))
    sku, table = upserts.load_mapping(
        batch, raw_sales, raw_expected, people, _skus(spark, ("S", xyz), ("Z", abc)), old
    )
    assert rows(sku) == [("S", abc), ("T", xyz), ("Z", abc)]
    assert rows(table, "sku_id", "va_number", "merchant_id") == [
        ("S", "V1", abc),
        ("T", "V2", xyz),
        ("Z", "KEEP", abc),
    ]
    assert upserts.mapping_counts(table).first().asDict() == {"mappings_loaded": 3, "distinct_skus": 3}


def test_mapping_without_merchant_stops_the_load(spark):
    args = (_people(spark, "ABC"), _skus(spark), bridge(spark))
    nobody = expected(spark, {"merchant": "who", "sku_id": "S"})
    with pytest.raises(upserts.MissingMerchantError, match="'S'"):
        upserts.load_mapping(_batch(spark, ("", "S", "V")), sales(spark), nobody, *args)


def test_product_with_two_merchants_stops_the_load(spark):
    people = _people(spark, "ABC", "XYZ")
    with pytest.raises(ValueError, match="two different"):
        upserts.load_mapping(
            _batch(spark, ("", "S", "V")), sales(spark, ("ABC", "S", "1")),
            expected(spark, {"merchant": "XYZ", "sku_id": "S"}), people, _skus(spark), bridge(spark),
        )


@pytest.mark.parametrize(
    ("listed", "wanted"),
    [
        (["a"], {"a": True, "b": False, None: None}),
        (["a", None], {"a": True, "b": None, None: None}),
        ([], {"a": False, "b": False, None: False}),
    ],
)
def test_three_valued_membership(spark, listed, wanted):
    values = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([(v,) for v in listed], "k string")
    assert dict(rows(exists_in(values, other, "k", "hit"))) == wanted
