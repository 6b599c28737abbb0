import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapdiff.functions import text as tx
from snapdiff.functions.patterns import anchored, java_regex, java_replacement
from snapdiff.model import ConfigError, Replacement, delimiter_char
from snapdiff.operators.records import canonical_records, distinct_records, fingerprint, with_fields


def test_delimiter_keywords():
    got = [delimiter_char(k) for k in ("PIPE", "tab", "Comma", "COLON", "semicolon", "TILDE", "caret", "x", "")]
    assert got == ["|", "\t", ",", ":", ";", "~", "^", "|", "|"]


def test_delimiter_column(values):
    assert values(tx.delimiter_of, "pipe", "TAB", "nothing", None) == ["|", "\t", "|", "|"]


@pytest.mark.parametrize("delimiter", list("|\t,:;~^"))
def test_split_keeps_trailing_empties(spark, delimiter):
    line = delimiter.join(["a", "", "b.c", "", ""])
    df = with_fields(spark.createDataFrame([(line,), ("",)], "record string"), delimiter)
    assert [r.fields for r in df.collect()] == [["a", "", "b.c", "", ""], [""]]


def test_field_positions(spark):
    f = F.split(F.lit("a|b|c"), r"\|", -1)
    row = spark.range(1).select(*[tx.field_at(f, i).alias(f"f{i}") for i in (0, 2, 3, -1, -3, -4)]).first()
    assert list(row) == ["a", "c", None, "c", "a", None]


CELLS = [
    ("x\ny", "a|b", "t\tt", "né中\U0001f600", None),
    ('q "z" w', "", "r\rs", "back\\slash", "end"),
]


@pytest.mark.parametrize("delimiter, expected", [
    ("|", ["xy|a;b|t t|n|", 'q "z" w||r\rs|back\\slash|end']),
    ("\t", ["xy\ta|b\tt;t\tn\t", 'q "z" w\t\tr\rs\tback\\slash\tend']),
    (";", ["xy;a|b;t t;n;", 'q "z" w;;r\rs;back\\slash;end']),
])
def test_canonical_records(spark, delimiter, expected):
    df = spark.createDataFrame(CELLS, "a string, `b.x` string, `c``d` string, d string, e string")
    assert [r.record for r in canonical_records(df, delimiter).collect()] == expected


def test_fingerprint_is_frozen(values):
    """A change in these values would report every record of every feed as changed."""
    texts = ["a|b|c", "", "naïve|中"]
    assert values(fingerprint, *texts) == [hashlib.md5(t.encode()).hexdigest() for t in texts]
    assert values(fingerprint, "a|b|c") == ["2e077b3ec5932ac3cf914ebdf242b4ee"]


def test_ascii_fold(values):
    assert values(tx.ascii_fold, "plain", "é", "a b", "x\U0001f600y", "", None) == ["plain", "", "ab", "xy", "", None]


def test_distinct(records):
    assert sorted(r.record for r in distinct_records(records("a", "b", "a", "a")).collect()) == ["a", "b"]


def test_blank(values):
    assert values(tx.is_blank, "", " ", "\t\n", " 　", " x ", "\x00") == [True, True, True, True, False, False]


def test_replacements(values):
    def run(*pairs, fold_last=False):
        rules = [Replacement(f, r) for f, r in pairs]
        return lambda c: tx.replace_literals(c, rules, fold_last)

    assert values(run(("|", ";")), "a|b|é") == ["a;b;"]
    # In order: what one rule puts in, the next can find.
    assert values(run(("a", "b"), ("b", "c")), "ab") == ["cc"]
    # Folding before the next rule, or before formatting, drops accents a rule put in.
    assert values(run(("a", "é"), ("b", "ü")), "ab") == ["ü"]
    assert values(run(("a", "é"), ("b", "ü"), fold_last=True), "ab") == [""]
    assert values(run(), "é") == ["é"]
    # No pattern meaning.
    assert values(run((".", "$1")), "a.b") == ["a$1b"]


def test_empty_find_is_refused():
    with pytest.raises(ConfigError):
        Replacement.of({"find": "", "replace": "x"})


NUMBER_GRAMMAR = [
    ("12", True, True), (" 12 ", True, True), ("+5", True, True), ("-5", True, True), ("1.5", False, True),
    (".5", False, True), ("5.", False, True), ("1e5", False, True), ("1E+05", False, True), ("inf", False, True),
    ("-Infinity", False, True), ("NaN", False, True), ("1f", False, False), ("1d", False, False),
    ("0x1p3", False, False), ("1_000", False, False), ("", False, False), (".", False, False),
    ("e5", False, False), ("1 2", False, False), ("99999999999999999999999", True, True),
    ("١٢", True, True), ("\x001", False, False), ("12\n", True, True), ("--1", False, False),
]


def test_number_grammar(values):
    texts, whole, number = map(list, zip(*NUMBER_GRAMMAR))
    assert list(zip(texts, values(tx.is_integer, *texts))) == list(zip(texts, whole))
    assert list(zip(texts, values(tx.is_decimal, *texts))) == list(zip(texts, number))


SEARCHES = [
    (r"^a$", "a\n", True), (r"^a\Z", "a\n", False), (r"a.b", "a\rb", True), (r"a.b", "a\nb", False),
    (r"[[a]", "[", True), (r"[]a]+", "]", True), (r"[^]a]", "]", False), (r"[a&&b]", "&", True),
    (r"(?P<x>a)(?P=x)", "aa", True), (r"(?P<x_y>a)b", "ab", True), (r"a{,2}b", "aab", True),
    (r"x{y", "x{y", True), (r"\d", "١", False), (r"(?i)ABC", "abc", True), (r"\v", "\x0b", True),
    (r"[\]x]", "]", True), (r"a|b", "zb", True), (r"\\", "\\", True), (r"[\w.-]+@", "a.b-c@", True),
]


def test_regex_translation(spark):
    row = spark.range(1).select(*[
        tx.regex_search(F.lit(text), expression).alias(f"s{i}")
        for i, (expression, text, _) in enumerate(SEARCHES)]).first()
    assert [(e, t, got) for (e, t, _), got in zip(SEARCHES, row)] == SEARCHES


@pytest.mark.parametrize("expression", ["(", "[a", "(?(1)a|b)", "(a)(?(1)b|c)", "*a"])
def test_bad_patterns_are_refused(expression):
    with pytest.raises(ConfigError):
        java_regex(expression)


def test_anchored_at_start_only(values):
    match = lambda e: (lambda c: c.rlike(anchored(e)))
    assert values(match("b|a"), "abc", "bc", "cb", "x\na") == [True, True, False, False]
    assert values(match("(?m)a"), "x\na") == [False]


def test_regex_replace(values):
    swap = lambda c: tx.regex_replace(c, r"(?P<a>\w)-(\w)", r"\2\g<a>0$\\")
    assert values(swap, "x-y  \t ", "none") == ["yx0$\\", "none"]


def test_replacement_groups():
    assert java_replacement(r"\1\g<0>9", "(a)") == r"$1$0\9"
    with pytest.raises(ConfigError):
        java_replacement(r"\2", "(a)")


def test_regex_extract(values):
    assert values(lambda c: tx.regex_extract(c, r"\d+"), "a1b22c", "none", "") == ["122", "", ""]


@pytest.mark.parametrize("expression", ["x*", "x*?", "|x", "x|", r"\b", "(?=x)|a+", "(a)|(x*)", "x??b?", r"(?m)^|$", r"\s*", "()"])
def test_matches_of_empty_text(spark, expression):
    texts = ["", "x", "abxd", "xx", "xxaxx", "a b", "baax\nx", "é x", "  x  "]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(
        tx.regex_replace(F.col("t"), expression, r"<\g<0>>"), tx.regex_extract(F.col("t"), expression)).collect()
    assert [tuple(r) for r in rows] == [
        (re.sub(expression, r"<\g<0>>", t.rstrip(), flags=re.ASCII), "".join(m.group() for m in re.finditer(expression, t, re.ASCII)))
        for t in texts]
    assert spark.range(1).select(tx.regex_replace(F.lit(None).cast("string"), expression, "")).first()[0] is None


@given(st.lists(st.sampled_from(["x", "a", "x*", "x?", "x*?", "x??", "a+", "|", r"\b", "(?=a)", "[ax]"]), min_size=1, max_size=5),
       st.lists(st.text("xab ", max_size=8), min_size=1, max_size=5))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_replacement_is_that_of_python(spark, parts, texts):
    expression = "".join(parts)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(
        tx.regex_replace(F.col("t"), expression, "-")).collect()
    assert [r[0] for r in rows] == [re.sub(expression, "-", t.rstrip()) for t in texts]
