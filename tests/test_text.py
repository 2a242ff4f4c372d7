from pyspark.sql import functions as F

from sparkrec.functions import text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _v) in values.items())
    return spark.createDataFrame([tuple(v for _t, v in values.values())], schema).select(column.alias("x")).first().x


def test_clean_collapses_every_white_space(spark):
    assert one(spark, text.clean("v"), v=("string", "  a    b\t\nc ")) == "a b c"
    assert one(spark, text.clean("v"), v=("string", " 　 ")) is None
    assert one(spark, text.clean("v"), v=("string", None)) is None


def test_source_category(spark):
    make = text.source_category("m", "c")
    assert one(spark, make, m=("string", "Games "), c=("array<string>", ["x"])) == "Games "
    assert one(spark, make, m=("string", "  "), c=("array<string>", ["x", "y"])) == "x"
    assert one(spark, make, m=("string", None), c=("array<string>", [])) == "unknown"


def test_category_paths(spark):
    assert one(spark, text.category_path("c"), c=("array<string>", [" A  b ", "", "C"])) == "A b > C"
    assert one(spark, text.category_path("c"), c=("array<string>", ["  "])) is None
    assert one(spark, text.split_category_path("c"), c=("string", "A > B >  C ")) == ["A", "B", "C"]
    for empty in (None, "", " > "):
        assert one(spark, text.split_category_path("c"), c=("string", empty)) is None


def test_raw_categories(spark):
    make = text.raw_categories("c", "m")
    assert one(spark, make, c=("array<string>", ["a", None, " ", "b", "c", "d"]), m=("string", "z")) == ["a", "b", "c"]
    assert one(spark, make, c=("array<string>", None), m=("string", " z ")) == ["z"]
    assert one(spark, make, c=("array<string>", None), m=("string", None)) == []


def test_parse_price(spark):
    cases = {"$1,234.50": 1234.5, " 19.9 ": 19.9, "1e3": 1000.0, "1_000": 1000.0, "0": None, "-3": None, "abc": None,
             "nan": None, "inf": None, "1.5f": None, "": None, None: None}
    for given, expected in cases.items():
        assert one(spark, text.parse_price("v"), v=("string", given)) == expected
    assert one(spark, text.parse_price("v"), v=("double", 12.5)) == 12.5
    assert one(spark, text.parse_price("v"), v=("double", float("nan"))) is None


def test_item_text_skips_missing_parts(spark):
    make = text.item_text("t", "c")
    assert one(spark, make, t=("string", " Red  Dead "), c=("array<string>", ["a", "b"])) == "Red Dead | a > b"
    assert one(spark, make, t=("string", None), c=("array<string>", ["a"])) == "a"
    assert one(spark, make, t=("string", "x"), c=("array<string>", [])) == "x"


def test_descriptions(spark):
    make = text.display_description("c", "p")
    assert one(spark, make, c=("string", "Phones"), p=("double", 12.5)) == "Phones · $12.50"
    assert one(spark, make, c=("string", "Phones"), p=("double", None)) == "Phones"
    assert one(spark, make, c=("string", ""), p=("double", 1.0)) is None
    back = text.split_description("d")
    for given, expected in {"A · B · $1.00": ("A · B", "$1.00"), "A · $5 · x": ("A · $5 · x", ""),
                            "Phones": ("Phones", ""), None: ("", "")}.items():
        assert tuple(one(spark, back, d=("string", given))) == expected


def test_epoch_millis(spark):
    shown = F.date_format(text.from_epoch_millis("ms"), "yyyy-MM-dd HH:mm:ss.SSS")
    assert one(spark, shown, ms=("long", 1_700_000_000_123)) == "2023-11-14 22:13:20.123"
