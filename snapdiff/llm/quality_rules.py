"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words

MIN_WORDS = 50        # fixed by the contract
MAX_REPEATED = 50     # per cent of words, fixed by the contract
SYMBOLS = "[#*$%&|<>]"

# Frequent function words per language.
STOP_WORDS = {
    "de": "der die das und in zu den von mit ist des im für auf nicht ein eine als auch er dem es an sich".split(),
    "en": "the of and to in a is that for it with as was on be by this are from at or an not".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es lo como".split(),
    "fr": "de la le et les des en un une que est pour qui dans par sur au pas plus avec ce il du".split(),
}


@dataclass(frozen=True)
class Rule:
    """A document passes if `low <= metric <= high`; an undefined metric passes."""

    metric: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", high=0.10),
    Rule("shouts_per_word", high=0.10),
    Rule("capital_share", high=0.30),
    Rule("stop_word_share", low=0.02),
    Rule("dup_line_share", high=0.50),
)


def _repeated(w: Column) -> Column:
    """Words lying in a three-word window that occurs at least twice."""
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(p: Column) -> Column:  # length of the union of [i, i + 3)
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def starts(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                        | ((k > 0) & F.coalesce(F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def count(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(let(ordered, starts), covered))

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(grams, count)).cast("long")


def measures(text: Column, lang: Column) -> Column:
    """Every count of one text, as one struct; a null text counts as empty."""
    t = F.coalesce(text, F.lit(""))
    bare = F.regexp_replace(t, SPACE + "+", "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stop = F.coalesce(*[F.when(lang == code, F.array(*map(F.lit, listed))) for code, listed in STOP_WORDS.items()],
                      F.lit(None).cast("array<string>"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated(w).alias("n_repeat_words"),
            F.when(stop.isNotNull(), F.size(F.filter(w, lambda x: F.array_contains(stop, F.lower(x))))
                   ).cast("long").alias("n_stop_words"))

    return F.struct(
        let(words(t), of_words).alias("w"),
        F.length(bare).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_shouts"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))
            ).alias("lines"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with counts, `base_failed` and `kept`, in one projection and no shuffle.

    Words are runs without ASCII white space. A null or empty text has no words
    and fails the base rules. A null or unlisted language has no stop-word share,
    and an undefined share passes. Repeated rows and equal ids are judged alike.
    Existing columns with the names of the results are replaced; all others stay.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rest = [docs[f"`{c}`"] for c in docs.columns if c.lower() not in added]
    # The one-element generator pins the measures: no rule computes them again.
    pinned = docs.select(*rest, F.inline(F.array(F.struct(measures(docs["text"], docs["lang"]).alias("_m")))))
    m = pinned["_m"]
    n, n_lines = m["w"]["n_words"], m["lines"]["n"]
    share = {
        "mean_word_chars": F.try_divide(m["word_chars"], n),
        "symbols_per_word": F.try_divide(m["n_symbols"], n),
        "shouts_per_word": F.try_divide(m["n_shouts"], n),
        "capital_share": F.try_divide(m["n_capitals"], m["word_chars"]),
        "stop_word_share": F.try_divide(m["w"]["n_stop_words"], n),
        "dup_line_share": F.try_divide(m["lines"]["dup"], n_lines),
    }
    tests = [F.coalesce(share[r.metric] >= r.low, F.lit(True)) for r in rules if r.low is not None]
    tests += [F.coalesce(share[r.metric] <= r.high, F.lit(True)) for r in rules if r.high is not None]
    failed = (n < MIN_WORDS) | (100 * m["w"]["n_repeat_words"] > MAX_REPEATED * n)
    return pinned.select(
        *[pinned[f"`{c}`"] for c in pinned.columns if c != "_m"],
        n.alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["lines"]["dup"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & reduce(Column.__and__, tests, F.lit(True))).alias("kept"))


def kept_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that pass, with their own columns only."""
    judged = quality_rules(docs.select(F.struct("*").alias("_row"), "text", "lang"), rules)
    return judged.where("kept").select("_row.*")
