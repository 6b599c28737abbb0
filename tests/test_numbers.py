from decimal import MAX_EMAX, MIN_EMIN, ROUND_HALF_EVEN, Context, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from snapdiff.functions import numbers as nm, typed
from snapdiff.model import ConfigError

DECIMALS = ["1234.50", "+5", "007.50", "-0.00", "1e5", "1E+5", ".5", "5.", " 5 ", "0", "000", "-.25", "0.000001",
            "0.0000001", "0.00000010", "12e-3", "1.5e10", "-1.20e-9", "0e3", "0.0000000", "123456789012345678901234567890.5",
            "0e-9", "10e2", "1e0"]


def test_decimal_text(values):
    assert values(nm.parse_decimal, *DECIMALS) == [str(Decimal(text.strip())) for text in DECIMALS]


def test_decimal_text_property(spark):
    """Canonical text for any finite decimal, however it is written."""
    digits = st.text("0123456789", min_size=1, max_size=12)
    written = st.builds(
        lambda s, a, b, e: s + a + b + e, st.sampled_from(["", "+", "-"]), digits,
        st.one_of(st.just(""), st.just("."), digits.map("." .__add__)),
        st.one_of(st.just(""), st.integers(-12, 12).map("e{}".format), st.integers(0, 9).map("E+{}".format)))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(written, min_size=200, max_size=200))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r.t: r.v for r in df.select("t", nm.parse_decimal(F.col("t")).alias("v")).collect()}
        assert got == {t: str(Decimal(t)) for t in texts}

    check()


WIDE = ["123456789012345678901234.5", "1e25", "0.0005000000000000000001", "2.6650000000000000001", "1e99999999999",
        "1e-9999999999", "15e2147483647", "1.5e-2147483648", "1e" + "9" * 50, "-0.0001", "0e5", "999.9995",
        "9999999999999999999999.9995", "-" + "9" * 40 + ".9996", "-0", "1e9999", "1e10000", "1.0005", "1.0015",
        "12345678901234567890.1234567890123456785", "0.00000000000000000000000000000000049"]


def printed(text, least, most, prefix=""):
    """What a number prints as, by exact decimal arithmetic; None if no text could hold it."""
    with localcontext(Context(prec=12_000, Emax=MAX_EMAX, Emin=MIN_EMIN, traps=[])):
        number = Decimal(text)
        if not number.is_finite() or (number and number.adjusted() + 1 > nm.MOST_DIGITS):
            return None
        unit = Decimal(1).scaleb(-most)
        small = not number or number.adjusted() < -most - 1
        whole, _, decimals = format(abs(Decimal(0) if small else number).quantize(unit, ROUND_HALF_EVEN), ",f").partition(".")
    decimals = decimals.rstrip("0").ljust(least, "0") if least < most else decimals
    return ("-" if text.startswith("-") else "") + prefix + whole + ("." + decimals if decimals else "")


def test_wide_numbers(values):
    """Any number prints exactly, whatever its digits, and none raises."""
    assert values(nm.format_decimal, *WIDE) == [printed(t, 0, 3) for t in WIDE]
    assert values(nm.format_currency, *WIDE) == [printed(t, 2, 2, "$") for t in WIDE]
    with localcontext(Context(prec=100, Emax=MAX_EMAX, Emin=MIN_EMIN, traps=[])):
        assert values(nm.parse_decimal, *WIDE) == [str(Decimal(t)) if Decimal(t).is_finite() else None for t in WIDE]


def test_wide_numbers_property(spark):
    digits = st.text("0123456789", min_size=1, max_size=32)
    ties = st.builds("{}.{}{}".format, digits, st.text("0159", min_size=2, max_size=4), st.sampled_from(["5", "50" * 9, "5" + "0" * 20 + "1"]))
    plain = st.builds("{}{}.{}{}".format, st.sampled_from(["", "-"]), digits, digits, st.sampled_from(["", "e20", "E-7", "e-30"]))

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.one_of(ties, plain), min_size=100, max_size=100))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        rows = df.select("t", nm.format_decimal(F.col("t")).alias("d"), nm.format_currency(F.col("t")).alias("c")).collect()
        assert {(r.t, r.d, r.c) for r in rows} == {(t, printed(t, 0, 3), printed(t, 2, 2, "$")) for t in texts}

    check()


@pytest.mark.parametrize("text, expected", [
    ("10000000.5", "10000000.5"), ("0.0001", "0.0001"), ("-3", "-3"), ("-0.2500", "-0.25"), ("0.0000000001", "0.0000000001"),
    ("0", "0"), ("100", "100"), ("12345678901234567890123456.75", "12345678901234567890123456.75")])
def test_json_number(spark, text, expected):
    value = F.lit(text).cast("decimal(38,10)")
    assert spark.range(1).select(nm.json_number(value)).first()[0] == expected


def test_parse_decimal(values):
    assert values(nm.parse_decimal, "$1,234.50", "-$5", "$-1,000", "n/a", "", "1.2.3", "$") == [
        "1234.50", "-5", "-1000", None, None, None, None]


def test_parse_number(values):
    assert values(nm.parse_number, "$1,234", "-0", "007", "+5", "1.5", "1e3", "99999999999999999999999999999999999999999", "x") == [
        "1234", "0", "7", "5", None, None, "9" * 41, None]


GROUPED = [
    ("1234.5", "1,234.5"), ("$1234.5678", "1,234.568"), ("0.0005", "0"), ("0.0015", "0.002"), ("0.0025", "0.002"),
    ("-1234567", "-1,234,567"), ("12", "12"), ("1e3", "1,000"), ("1,234.50", None), ("n/a", None), (".5", "0.5"),
    ("-0.0001", "-0"), ("12345678901234567890.5", "12,345,678,901,234,567,890.5"),
]

MONEY = [
    ("1234.5", "$1,234.50"), ("-1234.5", "-$1,234.50"), ("$5", "$5.00"), ("2.665", "$2.66"), ("2.675", "$2.68"),
    ("-0.001", "-$0.00"), ("1,234.50", None), ("x", None), ("", None),
]


def test_format_decimal(values):
    texts = [text for text, _ in GROUPED]
    assert list(zip(texts, values(nm.format_decimal, *texts))) == GROUPED
    assert list(zip(texts, values(nm.format_number, *texts))) == GROUPED


def test_format_currency(values):
    texts = [text for text, _ in MONEY]
    assert list(zip(texts, values(nm.format_currency, *texts))) == MONEY


@pytest.mark.parametrize("text, args, expected", [
    ("$1,234.5", ("en_US", "USD"), "$1,234.50"), ("-1234.5", ("en_US", "USD", "accounting"), "($1,234.50)"),
    ("1234.5", ("en_GB", "GBP"), "£1,234.50"), ("1.234,5", ("de_DE", "EUR"), "1.234,50\xa0€"),
    ("-1.234,5", ("de_DE", "EUR", "accounting"), "-1.234,50\xa0€"),
    ("1 234,5", ("fr_FR", "EUR"), "1 234,50\xa0€"), ("-2,5", ("fr_FR", "EUR", "accounting"), "(2,50\xa0€)"),
    ("1234.5", ("en_US", "JPY"), "¥1,234"), ("x", ("en_US", "USD"), None), ("1.5", ("fr_FR", "EUR"), None),
])
def test_currency_locales(values, text, args, expected):
    assert values(lambda c: nm.currency(c, *args), text) == [expected]


@pytest.mark.parametrize("args", [("xx_XX", "USD"), ("en_US", "XXX"), ("en_US", "USD", "fancy")])
def test_unknown_currency_arguments_are_refused(args):
    with pytest.raises(ConfigError):
        nm.currency(F.lit("1"), *args)


def test_json_number(spark):
    df = spark.createDataFrame([(Decimal("5.00"),), (Decimal("2.50"),), (Decimal("-2.50"),), (Decimal("-3.00"),),
                                (Decimal("0.00"),)], "v decimal(10,2)")
    assert [r.n for r in df.select(nm.json_number(F.col("v")).alias("n")).collect()] == ["5", "2.5", "-2.5", "-3", "0"]


def test_typed_projection(spark):
    schema = typed.build_schema([
        {"name": "i", "type": "integer"}, {"name": "l", "type": "long"}, {"name": "d", "type": "decimal"},
        {"name": "p", "type": "decimal(8,2)"}, {"name": "f", "type": "float"}, {"name": "x", "type": "double"},
        {"name": "day", "type": "date"}, {"name": "at", "type": "timestamp"}, {"name": "s", "type": "string"},
        {"name": "u", "type": "whatever"}, {"name": "gone", "type": "string"}])
    assert [f.dataType.simpleString() for f in schema] == [
        "int", "bigint", "decimal(10,0)", "decimal(8,2)", "float", "double", "date", "timestamp", "string", "string", "string"]
    good = "1|2|3.7|4.256|0.5|1e3|2018-09-10|2018-09-10 01:02:03|x|y".split("|")
    rows = typed.typed_projection(spark.createDataFrame([(good,), (["x"] * 3,)], "fields array<string>"), schema).collect()
    assert (rows[0].i, rows[0].l, rows[0].d, rows[0].p, rows[0].x, rows[0].u) == (1, 2, Decimal(4), Decimal("4.26"), 1000.0, "y")
    assert str(rows[0].day) == "2018-09-10" and rows[0].gone is None
    assert list(rows[1]) == [None] * 11


def test_json_text(spark):
    schema = "struct<a: bigint, b: string>"
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("broken",)], "t string")
    got = [r.v for r in df.select(typed.json_encode(typed.json_decode(F.col("t"), schema)).alias("v")).collect()]
    assert got == ['{"a":1,"b":"x"}', "{}"]


WIDE_TEXTS = st.tuples(st.sampled_from(["", "-", "+", " -"]), st.text("0123456789", max_size=60), st.text("0123456789", max_size=30) | st.sampled_from(
    ["5", "05", "0005", "00050", "00051", "9995", "99949", "9" * 25, "125", "0"])).filter(lambda x: x[1] or x[2])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.large_base_example, HealthCheck.data_too_large, HealthCheck.too_slow])
@given(st.lists(WIDE_TEXTS, min_size=120, max_size=120))
def test_wide_texts_print_as_decimals(values, numbers):
    """Numbers that hold all their digits, against exact arithmetic, for each number of decimals."""
    texts = [f"{sign}{whole}.{frac} " for sign, whole, frac in numbers]
    with localcontext(Context(prec=300, rounding=ROUND_HALF_EVEN)):
        def want(text, prefix, least, most):
            value = Decimal(text.strip()).quantize(Decimal(1).scaleb(-most))
            whole, _, frac = f"{abs(value):,f}".partition(".")
            held = frac[:least] + frac[least:].rstrip("0")
            return ("-" if text.strip().startswith("-") else "") + prefix + whole + ("." + held if held else "")

        for prefix, least, most in (("", 0, 3), ("$", 2, 2), ("", 0, 0)):
            for shown in (nm._printed_digits, nm._grouped):
                assert values(lambda c: shown(c, prefix, least, most), *texts) == [want(t, prefix, least, most) for t in texts]
                bare = [t.strip() for t in texts]
                assert values(lambda c: shown(c, prefix, least, most), *bare) == [want(t, prefix, least, most) for t in texts]


def test_texts_of_any_length_are_printed(values):
    digits = "1" + "234567890" * 3000
    shown = values(nm.format_decimal, digits + ".1255")[0]
    assert shown.replace(",", "") == digits + ".126" and all(len(p) == 3 for p in shown[:-4].split(",")[1:])
