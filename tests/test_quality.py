import json

import pytest
from pyspark.sql import functions as F

from snapdiff.model import ConfigError, FeedSpec, ValidationRule, format_rules, replacements, validation_rules
from snapdiff.operators.validation import Quality, tag
from snapdiff.operators.formatting import Cleaning


def rules(*items):
    return Quality(tuple(ValidationRule.of(i) for i in items))


def field(index, data_type, **more):
    return {"validation_type": "Field", "column_index": index, "data_type": data_type, **more}


@pytest.fixture
def bad(records):
    """Which of the lines are bad."""
    def run(quality, *lines, delimiter="|"):
        got = quality.mark(records(*lines), delimiter).collect()
        return {r.record: r.is_bad for r in got}
    return run


def test_off(bad):
    assert bad(Quality(), "anything", "") == {"anything": False, "": False}


def test_arity(bad):
    q = rules({"validation_type": "RECORD", "column_count": "3"})
    assert bad(q, "a|b|c", "||", "a|b", "a|b|c|d", "") == {
        "a|b|c": False, "||": False, "a|b": True, "a|b|c|d": True, "": True}


@pytest.mark.parametrize("data_type, more, good, wrong", [
    ("date", {"expression": "%m/%d/%y"}, ["01/31/18", "1/1/18", "?", "", "  "], ["02/30/18", "x", " ?", "01/01/18 "]),
    ("decimal", {}, ["1,234.50", "1e5", " 2 ", "nan", "?", "", " \t"], ["n/a", "1.2.3", ",", "$5", "??"]),
    ("integer", {}, ["1,234", "-5", "99999999999999999999", "?", ""], ["1.0", "x1", ",", "1e5"]),
    ("string", {"length": "3"}, ["abc", "", "?", "     ", "é中x"], ["abcd", " abc", "ab  "]),
    ("regex", {"expression": "[1-5]-|x"}, ["1-URGENT", "x", "?", ""], ["URGENT 1-", "9-", " 1-"]),
    ("UNKNOWN", {}, ["anything", "", "?"], []),
])
def test_field_rules(bad, data_type, more, good, wrong):
    q = rules(field("1", data_type, **more))
    lines = {f"k{i}|{v}|z": v in wrong for i, v in enumerate(good + wrong)}
    assert bad(q, *lines) == lines


@pytest.mark.parametrize("data_type, more", [
    ("date", {"expression": "%Y"}), ("decimal", {}), ("string", {"length": 5}), ("postcode", {})])
def test_missing_field_is_bad(bad, data_type, more):
    assert bad(rules(field(2, data_type, **more)), "a|b", "a|b|") == {"a|b": True, "a|b|": False}


def test_negative_positions(bad):
    assert bad(rules(field(-1, "integer")), "x|1", "1|x") == {"x|1": False, "1|x": True}
    assert bad(rules(field(-3, "integer")), "x|1", "1|x|y") == {"x|1": True, "1|x|y": False}


def test_any_rule_condemns(bad):
    q = rules(field(0, "integer"), field(1, "string", length=2))
    assert bad(q, "1|ab", "x|ab", "1|abc") == {"1|ab": False, "x|ab": True, "1|abc": True}


def test_record_regex(bad):
    q = Quality(record_regex=r"\d+\|[OFP]")
    assert bad(q, "x1|Oz", "1|X", "") == {"x1|Oz": False, "1|X": True, "": True}


def test_numeric_record_example(bad):
    """Twelve numeric fields, some optional or a question mark."""
    optional, number = r"-?(\d+)?\??", r"(-?\d*\.?\d+)"
    q = Quality(record_regex="^" + r"\|".join([optional] * 3 + [number, optional] + [number] * 7) + "$")
    good = "1|?||2.50|-3|.5|1|2|3|4|5|-6.0"
    assert bad(q, good, good.replace("2.50", "n/a"), good + "|7") == {
        good: False, good.replace("2.50", "n/a"): True, good + "|7": True}


def test_delimiters_are_literal(bad):
    assert bad(rules(field(1, "integer")), "a^1", "a^b", delimiter="^") == {"a^1": False, "a^b": True}


def test_tag(records):
    row = tag(records("é|x"), rules(field(1, "integer")), "|").first()
    assert (row.record, row.bad, len(row.hash)) == ("é|x", "True", 32)


def test_failed_rules(records):
    q = rules({"validation_type": "record", "column_count": 2}, field(0, "integer"), field(1, "decimal"))
    got = {r.record: r.failed_rules for r in q.explain_bad(records("1|2", "x|2", "x", "1|y|z"), "|").collect()}
    assert got == {"1|2": [], "x|2": ["0:integer"], "x": ["record", "0:integer", "1:decimal"],
                   "1|y|z": ["record", "1:decimal"]}
    assert Quality().explain_bad(records("x"), "|").first().failed_rules == []


@pytest.mark.parametrize("rule", [
    {}, {"validation_type": "record"}, {"validation_type": "record", "column_count": "x"},
    {"validation_type": "field", "data_type": "integer"}, {"validation_type": "field", "column_index": "0"},
    field(0, "date"), field(0, "regex"), field(0, "string"), field("a", "integer"),
])
def test_incomplete_rules_are_refused(rule):
    with pytest.raises(ConfigError):
        ValidationRule.of(rule)


@pytest.mark.parametrize("text", ["", "{", "[]", '{"other":[]}', '{"validates":{}}'])
def test_malformed_documents_are_refused(text):
    with pytest.raises(ConfigError):
        validation_rules(text)


def test_both_modes_are_refused():
    with pytest.raises(ConfigError):
        Quality(tuple(validation_rules('{"validates":[{"validation_type":"record","column_count":1}]}')), "x")


def test_numbers_and_strings_in_rules_mean_the_same():
    text = '{"validates":[{"validation_type":"f","column_index":%s,"data_type":"string","length":%s}]}'
    assert validation_rules(text % (1, 5)) == validation_rules(text % ('"1"', '"5"'))


def clean(records, spec, *lines):
    rows = Cleaning.of(spec).apply(records(*lines)).collect()
    return [r.record for r in rows], [r.format_errors for r in rows]


def formats(*items):
    return FeedSpec(format_data=True, formats_json=json.dumps({"formats": list(items)}))


DATE = {"column_index": "1", "format_type": "date", "in_expression": "%m/%d/%y", "out_expression": "%Y-%m-%d"}
MONEY = {"column_index": 2, "format_type": "Currency"}


def test_formats(records):
    out, errors = clean(records, formats(DATE, MONEY), "a|01/02/68|1234.5|z", "a|?|?|z", "a|||z", "a| | |z",
                        "a|x|n/a|z", "a|01/02/18", "", "a|01/02/18|5|")
    assert out == ["a|1968-01-02|$1,234.50|z", "a|?|?|z", "a|||z", "a| | |z", "a|x|n/a|z", "a|2018-01-02", "",
                   "a|2018-01-02|$5.00|"]
    assert errors == [[], [], [], [2], [1, 2], [], [], []]


def test_rules_on_one_field_apply_in_order(records):
    parse = {"column_index": 0, "format_type": "decimal", "function": "Parse"}
    show = {"column_index": 0, "format_type": "decimal", "function": "format"}
    assert clean(records, formats(parse, show), "$1,234.5")[0] == ["1,234.5"]
    assert clean(records, formats(show), "$1,234.5") == (["$1,234.5"], [[0]])


def test_formats_from_the_end(records):
    last = {**MONEY, "column_index": -1}
    assert clean(records, formats(last, DATE), "a|01/02/18|5", "5", "") == (
        ["a|2018-01-02|$5.00", "$5.00", ""], [[], [], []])


def test_unknown_format_changes_nothing(records):
    assert clean(records, formats({"column_index": 0, "format_type": "x"}), "a|b") == (["a|b"], [[]])


def test_no_format_rules_still_fold(records):
    assert clean(records, formats(), "é|b\\")[0] == ["|b"]
    assert clean(records, FeedSpec(), "é|b\\")[0] == ["é|b"]


def test_formatting_splits_the_replaced_record(records):
    spec = FeedSpec(replace_data=True, replacements_json='{"replacements":[{"find":"#","replace":"|"}]}',
                    format_data=True, formats_json=json.dumps({"formats": [DATE]}))
    assert clean(records, spec, "a#01/02/18|z")[0] == ["a|2018-01-02|z"]


def test_delimiter_of_formats(records):
    spec = FeedSpec(source_delimiter="CARET", format_data=True, formats_json=json.dumps({"formats": [DATE]}))
    assert clean(records, spec, "a^01/02/18^z")[0] == ["a^2018-01-02^z"]


@pytest.mark.parametrize("rule", [
    {}, {"column_index": 0}, {"column_index": 0, "format_type": "date"},
    {"column_index": 0, "format_type": "decimal"}, {"column_index": "x", "format_type": "currency"}])
def test_incomplete_formats_are_refused(rule):
    with pytest.raises(ConfigError):
        format_rules(json.dumps({"formats": [rule]}))


def test_malformed_replacements_are_refused():
    with pytest.raises(ConfigError):
        replacements('{"replacements":[{"find":"a"}]}')


def test_unpaired_quality_is_lazy(records):
    """A flag nobody reads costs no split."""
    q = rules(field(1, "integer"))
    plan = q.mark(records("a|1"), "|").select("record")._jdf.queryExecution().optimizedPlan().toString()
    assert "split" not in plan


def test_judged_once(records):
    """Filters on the flag stay above the projection that splits the record."""
    q = rules(field(0, "integer"), field(1, "decimal"))
    plan = q.mark(records("1|2"), "|").where(F.col("is_bad"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
