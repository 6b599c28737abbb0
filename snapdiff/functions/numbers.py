"""Number text: parsing, grouping and currency formats as columns.

Each function returns null where the text is not a number it can handle, so
the caller decides what a failure leaves behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ..model import ConfigError
from .patterns import WHITESPACE, WS_CLASS
from .text import without_commas

_NUMBER = rf"\A{WS_CLASS}*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?{WS_CLASS}*\z"
_WHOLE = rf"\A{WS_CLASS}*(?:\+|(-))?0*([1-9]\d*){WS_CLASS}*\z"

# Decimal text that is canonical already, and text that only has a plus sign,
# leading zeros, a final point or blanks to lose. Neither covers exponents or
# numbers so small that their text turns scientific.
_CANONICAL = r"\A-?(?:0(?!\.0{6})|[1-9]\d*)(?:\.\d+)?\z"
_PLAIN = rf"\A{WS_CLASS}*(?:\+|(-))?(?!0+\.0{{6}})0*(\d+)(\.\d+)?\.?{WS_CLASS}*\z"

# Text that fits this type exactly is printed by way of it; any other, digit by digit.
_WORKING = "decimal(38,18)"
_FITS = r"\A[+-]?(?:\d{1,20}(?:\.\d{0,18})?|\.\d{1,18})\z"

# Text that fits this type with six decimals; of those beyond, it only matters whether any is not zero.
_WIDER = "decimal(38,7)"
_FITS_CUT = r"\A[+-]?\d{1,31}\.\d{7,}+\z"

# Any other text without an exponent holds all its digits.
_DIGITS = rf"\A{WS_CLASS}*+[+-]?(?:\d++(?:\.\d*+)?|\.\d++){WS_CLASS}*+\z"

# An exponent of any text is computed in this type; one beyond it counts as no number.
_EXPONENT = "decimal(38,0)"
# Whole digits an exponent may give a printed number: 1e2147483647 is a number, but no text can hold it.
MOST_DIGITS = 10_000


def without_dollar(text: Column) -> Column:
    return F.replace(text, F.lit("$"), F.lit(""))


def _stripped(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def _sign(number: Column) -> Column:
    return F.when(number.startswith("-"), "-").otherwise("")


def decimal_text(text: Column) -> Column:
    """Canonical text of a decimal number of any size; the scale is kept."""
    return (
        F.when(text.rlike(_CANONICAL), text)
        .when(text.rlike(_PLAIN), F.regexp_replace(text, _PLAIN, "$1$2$3"))
        .when(text.rlike(_NUMBER), _scientific(_stripped(text)))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value computed once.

    Also keeps a rarely taken branch out of the generated code, where it would
    push the method past the size the JVM compiles.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(number: Column) -> Column:
    """Sign, digits without leading zeros, and the power of ten of the last digit.

    Null if the power is beyond 38 digits.
    """
    mantissa = F.regexp_extract(number, r"\A[+-]?([\d.]*)", 1)
    written = F.regexp_extract(number, r"[eE]([+-]?\d+)\z", 1)
    exponent = F.when(written == "", F.lit(0).cast(_EXPONENT)).otherwise(written.try_cast(_EXPONENT))
    fraction = F.regexp_extract(number, r"\.(\d*)", 1)
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), r"\A0+(?=\d)", "")
    scale = F.try_subtract(exponent, F.length(fraction).cast(_EXPONENT)).try_cast(_EXPONENT)
    return F.when(scale.isNotNull(), F.struct(_sign(number).alias("sign"), digits.alias("digits"), scale.alias("scale")))


def _scientific(number: Column) -> Column:
    """Text of any number, the long way."""
    return _let(_parts(number), _from_parts)


def _shifted(digits: Column, scale: Column) -> Column:
    """Whole digits and decimals of `digits` with its point moved, for scales below a text's size."""
    size = F.length(digits)
    padded = F.lpad(digits, F.greatest(size, F.lit(1) - scale), F.lit("0"))
    return F.when(scale >= 0, F.struct(F.concat(digits, F.repeat(F.lit("0"), scale)).alias("whole"), F.lit("").alias("decimals"))).otherwise(
        F.struct(F.left(padded, F.length(padded) + scale).alias("whole"), F.right(padded, -scale).alias("decimals")))


def _from_parts(parts: Column) -> Column:
    sign, digits, scale = (parts.getField(n) for n in ("sign", "digits", "scale"))
    size = F.length(digits)
    power = F.try_add(scale, (size - 1).cast(_EXPONENT))
    plain = (scale <= 0) & (power >= -6)  # the scale is then no larger than the text
    fixed = _let(_shifted(digits, scale.try_cast("int")), lambda x: F.concat(
        x["whole"], F.when(x["decimals"] == "", "").otherwise(F.concat(F.lit("."), x["decimals"]))))
    spread = F.concat(
        F.left(digits, F.lit(1)), F.when(size > 1, ".").otherwise(""), F.substring(digits, F.lit(2), size),
        F.lit("E"), F.when(power < 0, "").otherwise("+"), power.cast("string"))
    return F.concat(sign, F.when(plain, fixed).otherwise(spread))


def _increased(digits: Column) -> Column:
    """A whole number's digits plus one."""
    nines = F.length(F.regexp_extract(digits, "(9*)\\z", 1))
    head = F.left(digits, F.length(digits) - nines)
    raised = F.when(head == "", "1").otherwise(F.concat(
        F.left(head, F.length(head) - 1), F.translate(F.right(head, F.lit(1)), "012345678", "123456789")))
    return F.concat(raised, F.repeat(F.lit("0"), nines))


def _printed(parts: Column, prefix: str, least: int, most: int) -> Column:
    """Any number with thousands grouped and `least` to `most` decimals, ties to even."""
    sign, digits, scale = (parts.getField(n) for n in ("sign", "digits", "scale"))
    point = F.try_add(scale, F.length(digits).cast(_EXPONENT))  # whole digits, negative below 0.1
    zero = (digits == "0") | (point < -most)                    # nothing of it reaches the last decimal
    near = F.when(zero, F.struct(F.lit("0").alias("whole"), F.lit("").alias("decimals"))).otherwise(
        _shifted(digits, scale.try_cast("int")))

    def rounded(x: Column) -> Column:
        kept = F.concat(x["whole"], F.left(F.rpad(x["decimals"], F.lit(most), F.lit("0")), F.lit(most)))
        rest = F.substring(x["decimals"], F.lit(most + 1), F.length(x["decimals"]))
        up = rest.rlike(r"\A(?:[6-9]|50*[1-9])") | (rest.rlike(r"\A50*\z") & kept.rlike(r"[13579]\z"))
        return F.when(up, _increased(kept)).otherwise(kept)

    def shown(kept: Column) -> Column:
        whole = F.left(kept, F.length(kept) - most)
        grouped = F.reverse(F.regexp_replace(F.reverse(whole), r"(\d{3})(?=\d)", "$1,"))
        if not most:
            return F.concat(sign, F.lit(prefix), grouped)
        decimals = F.right(kept, F.lit(most))
        if least < most:
            decimals = F.rpad(F.regexp_replace(decimals, r"0+\z", ""), F.greatest(F.lit(least), F.length(F.regexp_replace(decimals, r"0+\z", ""))), F.lit("0"))
        return F.concat(sign, F.lit(prefix), grouped, F.when(decimals == "", "").otherwise(F.concat(F.lit("."), decimals)))

    return F.when(zero | (point <= MOST_DIGITS), _let(_let(near, rounded), shown))


def _printed_digits(number: Column, prefix: str, least: int, most: int) -> Column:
    """`_printed` of a text that holds all its digits, of any length: cut, rounded once, grouped in one pass."""
    def rounded(x: Column) -> Column:
        kept = F.concat(x["whole"], F.rpad(F.left(x["decimals"], F.lit(most)), F.lit(most), F.lit("0")))
        rest = F.rtrim(F.substring(x["decimals"], F.lit(most + 1), F.length(x["decimals"])), F.lit("0"))
        up = (rest > "5") | ((rest == "5") & (F.ascii(F.right(kept, F.lit(1))) % 2 == 1))
        return F.struct(x["sign"].alias("sign"), F.when((F.length(x["decimals"]) > most) & up, _increased(kept)).otherwise(kept).alias("kept"))

    def shown(x: Column) -> Column:
        size = F.length(x["kept"]) - most
        filled = F.lpad(F.left(x["kept"], size), size + 2 - (size + 2) % 3, F.lit(" "))
        grouped = F.concat(x["sign"], F.lit(prefix), F.ltrim(F.array_join(F.regexp_extract_all(filled, F.lit("..."), F.lit(0)), ",")))
        if not most:
            return grouped
        decimals = F.right(x["kept"], F.lit(most))
        if least < most:
            decimals = F.concat(F.left(decimals, F.lit(least)), F.rtrim(F.substring(decimals, F.lit(least + 1), F.lit(most)), F.lit("0")))
        return F.concat(grouped, F.rtrim(F.concat(F.lit("."), decimals), F.lit(".")))

    def parts(text: Column) -> Column:
        whole = F.ltrim(F.substring_index(text, ".", 1), F.lit("+-0"))
        return F.struct(_sign(text).alias("sign"), F.when(whole == "", "0").otherwise(whole).alias("whole"), F.when(
            F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("").alias("decimals"))

    return _let(_let(_let(_stripped(number), parts), rounded), shown)


def parse_decimal(text: Column) -> Column:
    """Dollar signs and grouping commas removed, as canonical decimal text."""
    return decimal_text(without_commas(without_dollar(text)))


def parse_number(text: Column) -> Column:
    """As `parse_decimal`, for whole numbers only."""
    bare = without_commas(without_dollar(text))
    return (
        F.when(bare.rlike(r"\A(?:0|-?[1-9]\d*)\z"), bare)
        .when(bare.rlike(rf"\A{WS_CLASS}*[+-]?0+{WS_CLASS}*\z"), "0")
        .when(bare.rlike(_WHOLE), F.regexp_replace(bare, _WHOLE, "$1$2"))
    )


def _grouped(bare: Column, prefix: str, least: int, most: int) -> Column:
    """A number with thousands grouped and `least` to `most` decimals; null if it is none.

    Ties go to the even digit. The sign is taken from the text, because a decimal
    has no negative zero.
    """
    pattern = f"{prefix}#,##0{'.' if most else ''}{'0' * least}{'#' * (most - least)}"

    def shown(value: Column) -> Column:
        return F.call_function("format_number", value, F.lit(pattern))

    value = bare.try_cast(_WORKING)
    short = F.when(bare.startswith("-"), F.concat(F.lit("-"), shown(F.abs(value)))).otherwise(shown(value))

    def cut(text: Column) -> Column:
        point = F.instr(text, ".")
        beyond = F.rtrim(F.substring(text, point + 7, F.length(text)), F.lit("0"))
        return shown(F.abs(F.concat(F.substring(text, F.lit(1), point + 6), F.when(beyond == "", "0").otherwise("1")).try_cast(_WIDER)))

    def long(text: Column) -> Column:
        return F.when(text.rlike(_FITS_CUT), F.concat(_sign(text), cut(text))).when(text.rlike(_DIGITS), _printed_digits(text, prefix, least, most)).when(
            text.rlike(_NUMBER), _let(_parts(_stripped(text)), lambda parts: _printed(parts, prefix, least, most)))

    return F.when(bare.rlike(_FITS), short).otherwise(_let(bare, long))


def format_decimal(text: Column) -> Column:
    """Dollar signs removed; thousands grouped, at most three decimals."""
    return _grouped(without_dollar(text), "", 0, 3)


format_number = format_decimal  # same pattern


def format_currency(text: Column) -> Column:
    """Dollar signs removed; printed as US dollars."""
    return _grouped(without_dollar(text), "$", 2, 2)


@dataclass(frozen=True)
class _Locale:
    group: str
    decimal: str
    prefix: bool  # symbol before the number
    parentheses: bool  # accounting form of negatives
    symbols: dict[str, str]


# Separators, layout and symbols of each supported locale.
_LOCALES = {
    "en_US": _Locale(",", ".", True, True, {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥"}),
    "en_GB": _Locale(",", ".", True, True, {"USD": "US$", "EUR": "€", "GBP": "£", "JPY": "JP¥"}),
    "de_DE": _Locale(".", ",", False, False, {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥"}),
    "fr_FR": _Locale("\u202f", ",", False, True, {"USD": "$US", "EUR": "€", "GBP": "£GB", "JPY": "JPY"}),
}
_WHOLE_UNITS = {"JPY"}  # currencies without a minor unit


def currency(text: Column, locale: str = "en_US", code: str = "USD", format_type: str = "standard") -> Column:
    """Amount read and printed in a locale; `format_type` is standard or accounting."""
    if locale not in _LOCALES:
        raise ConfigError(f"unsupported locale {locale!r}; know {sorted(_LOCALES)}")
    rules = _LOCALES[locale]
    if code not in rules.symbols:
        raise ConfigError(f"unsupported currency {code!r}; know {sorted(rules.symbols)}")
    if format_type not in ("standard", "accounting"):
        raise ConfigError(f"unsupported currency format type {format_type!r}")
    bare = F.replace(without_dollar(text), F.lit(rules.group), F.lit(""))
    if rules.decimal != ".":
        # A point that is not the group separator is no part of a number here.
        bare = F.when(~F.contains(bare, F.lit(".")), F.replace(bare, F.lit(rules.decimal), F.lit(".")))
    # Every format prints the sign first; the symbol goes behind it, or the
    # whole amount into parentheses.
    decimals = 0 if code in _WHOLE_UNITS else 2
    amount = _grouped(bare, "", decimals, decimals)
    if rules.decimal != ".":
        amount = F.translate(amount, ",.", rules.group + rules.decimal)
    symbol = rules.symbols[code].replace("$", r"\$")
    shown = f"{symbol}$2" if rules.prefix else f"$2\xa0{symbol}"
    if format_type == "accounting" and rules.parentheses:
        amount = F.regexp_replace(amount, r"\A(-)(.*)\z", f"({shown})")
        return F.regexp_replace(amount, r"\A()([^(].*)\z", shown)
    return F.regexp_replace(amount, r"\A(-?)(.*)\z", f"$1{shown}")


def json_number(value: Column) -> Column:
    """Decimal value as JSON number text: plain digits, without trailing zeros."""
    text = value.cast("string")
    plain = F.when(text.rlike("[eE]"), decimal_plain(text)).otherwise(text)
    return F.when(value.isNotNull(), F.regexp_replace(plain, r"(?:(\.\d*[1-9])0+|\.0*)\z", "$1"))


def decimal_plain(text: Column) -> Column:
    """Any number's text without an exponent; null if it is longer than a text should be."""
    def spelled(parts: Column) -> Column:
        x = _shifted(parts["digits"], parts["scale"].try_cast("int"))
        bounded = F.abs(parts["scale"]) <= MOST_DIGITS
        return F.when(bounded, _let(x, lambda y: F.concat(
            parts["sign"], y["whole"], F.when(y["decimals"] == "", "").otherwise(F.concat(F.lit("."), y["decimals"])))))

    return _let(_parts(text), spelled)
