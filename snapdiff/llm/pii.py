"""Personal data by patterns, and terms that reveal it by corpus co-occurrence, all in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, small, staged, words

KINDS = ("email", "ip", "card", "phone")  # fixed by the contract, in this order
WINDOW = 10         # words on either side of an entity that count as its context
SUPPORT = 3         # different windows that must hold entity and term together
DISCLOSURE = 0.9    # share of an entity's information that a term may not reveal
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

# A dot between label characters and a separator between digits are replaced by
# one private character each: the patterns then repeat a single class, which the
# regex engine does in a loop, whatever the length of the run.
_SEP, _DOT = "", ""
_LOCAL = rf"A-Za-z0-9._%+{_DOT}\-"
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]+@[A-Za-z0-9\-]+{_DOT}[A-Za-z0-9{_DOT}\-]+"
_IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_CARD = rf"(?<![0-9{_SEP}])[0-9][0-9{_SEP}]{{15,}}"
_PHONE = r"\+[0-9][\x20().0-9\-]+[0-9]"
_TERM = r"\p{L}{3,}"
_CHUNK = 256


def _scan(x: Column, op: Callable[[Column, Column], Column]) -> Column:
    """What `op` makes of all values before each one, from 0; by chunks, so not quadratic."""
    zero = F.lit(0).cast("long")

    def plain(values: Column) -> Column:
        start = F.struct(zero.alias("s"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(values, start, lambda acc, v: F.struct(
            op(acc["s"], v).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")))["a"]

    def joined(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, zero, op))
        return let(plain(totals), lambda bases: F.flatten(F.transform(
            chunks, lambda c, i: F.transform(plain(c), lambda v: op(F.get(bases, i), v)))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _CHUNK).cast("int")),
                         lambda i: F.slice(x, i * _CHUNK + 1, _CHUNK))
    return F.when(F.size(x) > 0, let(chunks, joined)).otherwise(F.array().cast("array<bigint>"))


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    each = F.split(F.reverse(digits), "")
    value = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(value, F.lit(0), lambda a, v: a + v) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str) -> Callable[[Column], Column]:
    """The test of a match beyond its pattern."""
    return {
        "email": lambda v: F.lit(True),
        "ip": lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": lambda v: F.when(F.length(_digits(v)).between(16, 19), _luhn(_digits(v))).otherwise(F.lit(False)),
        "phone": lambda v: F.length(_digits(v)).between(8, 15),
    }[kind]


_MATCH = "array<struct<kind:string,start:bigint,end:bigint,value:string,left:array<string>,right:array<string>>>"


def _matches(text: Column, kind: str, pattern: Column, valid: Callable[[Column], Column]) -> Column:
    """Valid matches with their places, and the words before and after each."""
    def placed(found: Column, pieces: Column) -> Column:
        widths = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("long"))
        rows = let(_scan(widths, lambda a, b: a + b), lambda before: F.transform(found, lambda m, i: let(
            F.get(before, i) + F.length(F.get(pieces, i)), lambda start: F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"),
                let(words(F.get(pieces, i)), lambda w: F.slice(w, F.greatest(F.size(w) - WINDOW + 1, F.lit(1)), WINDOW)).alias("left"),
                F.slice(words(F.get(pieces, i + 1)), 1, WINDOW).alias("right")))))
        return F.filter(rows, lambda r: valid(r["value"]))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda p: placed(m, p)))
               .otherwise(F.array().cast(_MATCH)))


def _base(text: Column) -> Column:
    """All base matches of a text by kind as listed, then by start."""
    free = F.translate(text, _SEP + _DOT, "��")
    dotted = F.regexp_replace(free, r"(?<=[A-Za-z0-9\-])\.(?=[A-Za-z0-9\-])", _DOT)
    joined = F.regexp_replace(free, r"(?<=[0-9])[\x20\-](?=[0-9])", _SEP)
    none = F.array().cast(_MATCH)

    def of(kind: str, source: Column, pattern: str, worth: Column) -> Column:
        return F.when(worth, let(source, lambda t: _matches(t, kind, F.lit(pattern), _valid(kind)))).otherwise(none)

    return F.concat(
        of("email", dotted, _EMAIL, text.contains("@")),
        of("ip", text, _IP, text.rlike(_IP)),
        of("card", joined, _CARD, text.rlike(r"[0-9](?:[\x20\-]?[0-9]){15}")),
        of("phone", text, _PHONE, text.contains("+")))


def base_matches(docs: DataFrame) -> DataFrame:
    """`doc_id, text_key, matches` of every row; a null text counts as empty."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"], F.xxhash64(text).alias("text_key"), _base(text).alias("matches"))


def _entity(match: Column) -> Column:
    """One spelling per entity: digits of numbers, lower case otherwise."""
    plain = F.translate(match["value"], _DOT, ".")
    return F.concat_ws(":", match["kind"], F.when(match["kind"].isin("card", "phone"), _digits(plain)).otherwise(F.lower(plain)))


def _classes(match: Column) -> Column:
    """What an entity shares with others: its kind, and the domain of a mail address."""
    domain = F.concat(F.lit("domain:"), F.substring_index(F.lower(F.translate(match["value"], _DOT, ".")), "@", -1))
    return F.filter(F.array(match["kind"], F.when(match["kind"] == "email", domain)), lambda c: c.isNotNull())


def _is_class() -> Column:
    return F.col("entity").isin(*KINDS) | F.col("entity").startswith("domain:")


def _nearby(match: Column) -> Column:
    """The terms in the window of a match."""
    window = F.lower(F.concat_ws(" ", match["left"], match["right"]))
    return F.array_distinct(F.regexp_extract_all(window, F.lit(_TERM), F.lit(0)))


def disclosing_terms(docs: DataFrame, matches: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """`entity, term, share` of terms that reveal an entity, or a class of entities.

    Probabilities are shares of the different texts of the corpus: p(e) and p(t) of
    those that hold entity and term, p(e, t) of those where the term stands within
    the entity's window. The share is PMI(e; t) / -log2 p(e): 1 if no text holds the
    term without the entity. Copies of a text count once, and `support` asks for
    different windows, so that copies with other surroundings do not suffice either.
    Most entities occur once; their kind and mail domain recur and count as
    entities of their own.
    """
    m = F.col("m")
    context = matches.select("text_key", F.explode("matches").alias("m")).select(
        "text_key", F.explode(F.concat(F.array(_entity(m)), _classes(m))).alias("entity"),
        F.xxhash64("m.left", "m.right").alias("window"), _nearby(m).alias("terms")).distinct()
    context = staged(context, "contexts")
    pairs = context.select("entity", "window", "text_key", F.explode("terms").alias("term"))
    windows = pairs.select("entity", "term", "window").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n"))
    wide = staged(windows.where(F.col("n") >= support).select("entity", "term"), "supported")
    together = (pairs.select("entity", "term", "text_key").distinct().join(small(wide), ["entity", "term"])
                .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et")))
    near = pairs.select("term", "text_key").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_near"))
    n_e = staged(context.select("entity", "text_key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")), "entities")
    text = F.coalesce("text", F.lit(""))
    copies = docs.select(F.xxhash64(text).alias("_text")).groupBy("_text").agg(F.count(F.lit(1)).alias("_copies"))
    copies = staged(copies, "copies")
    total = float(copies.count())

    def share(n_t: str) -> Column:
        return F.log2(F.col("n_et") * total / (F.col("n_e") * F.col(n_t))) / F.log2(total / F.col("n_e"))

    # A term stands in at least the texts where it is near any entity, so its share is at most that of n_near.
    possible = together.join(small(n_e), "entity").where(F.col("n_e") < total).join(near, "term").where(share("n_near") >= disclosure)
    possible = staged(possible.select("entity", "term", "n_e", "n_et"), "possible")
    wanted = staged(possible.select("term").distinct(), "terms")
    spoken = docs.select(text.alias("text")).join(small(staged(copies.where("_copies > 1"), "repeated")), F.xxhash64("text") == F.col("_text"), "left")
    spoken = spoken.select(F.coalesce("_copies", F.lit(1)).alias("_copies"), F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0)))).alias("term")).join(small(wanted), "term")
    # A text with c copies gives a term c rows, so every class of c divides evenly and no text has to be told apart.
    n_t = (spoken.groupBy("term", "_copies").agg(F.count(F.lit(1)).alias("_n"))
           .groupBy("term").agg(F.sum(F.expr("_n div _copies")).alias("n_t")))
    return possible.join(n_t, "term").select("entity", "term", share("n_t").alias("share")).where(F.col("share") >= disclosure)


def find_personal(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """`doc_id, text_key, spans` of every row: base spans by kind and start, then revealing terms.

    A span is `kind, start, end` in code points, the end exclusive. A term is
    marked in every document that holds an entity it reveals, and one that reveals a
    class where it stands in the window of an entity of that class. Null and empty texts
    have no spans; rows equal in doc_id and text get equal spans.
    """
    matches = staged(base_matches(docs), "matches")
    some = matches.where(F.size("matches") > 0)
    revealing = staged(disclosing_terms(docs, some, support, disclosure), "revealing")
    each, m = some.select("doc_id", "text_key", F.explode("matches").alias("m")), F.col("m")
    held = each.select("doc_id", "text_key", _entity(m).alias("entity")).distinct()
    near = each.select("doc_id", "text_key", F.explode(_classes(m)).alias("entity"), _nearby(m).alias("terms"))
    near = near.select("doc_id", "text_key", "entity", F.explode("terms").alias("term")).distinct()
    of_one = revealing.where(~_is_class())
    marks = held.join(small(of_one), "entity").select("doc_id", "text_key", "term").union(
        near.join(small(revealing.where(_is_class())), ["entity", "term"]).select("doc_id", "text_key", "term"))
    marks = marks.groupBy("doc_id", "text_key").agg(F.collect_set("term").alias("terms"))
    marks = staged(marks.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "terms"), "marks")
    same = F.col("text_key").eqNullSafe(F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    named = texts.join(small(marks), same).select("_id", "_text", _matches(
        F.col("text"), "term", pattern, lambda v: F.lit(True)).alias("terms")).dropDuplicates(["_id", "_text"])
    joined = matches.join(small(staged(named, "named")), same, "left")
    spans = F.transform(F.concat("matches", F.coalesce("terms", F.array().cast(_MATCH))),
                        lambda m: F.struct(m["kind"], m["start"], m["end"]))
    return joined.select("doc_id", "text_key", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, general: dict[str, str] = GENERAL) -> Column:
    """The text with every span replaced by its general form; an overlapped one goes with the first."""
    label = F.create_map(*[F.lit(x) for pair in general.items() for x in pair])

    def build(s: Column) -> Column:
        def parts(done: Column) -> Column:
            each = F.transform(s, lambda x, i: F.when(x["start"] >= F.get(done, i), F.concat(
                F.substring(text, (F.get(done, i) + 1).cast("int"), (x["start"] - F.get(done, i)).cast("int")),
                F.element_at(label, x["kind"]))).otherwise(F.lit("")))
            end = F.array_max(F.transform(s, lambda x: x["end"]))
            return F.concat(F.array_join(each, ""), F.substring(text, (end + 1).cast("int"), F.length(text)))

        return let(_scan(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b)), parts)

    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                           .otherwise((b["end"] - a["end"]).cast("int")))
    return F.when(F.size(spans) == 0, text).otherwise(let(ordered, build))


def sanitised(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """`docs` with personal data and revealing terms generalised in `text`; other columns stay."""
    found = find_personal(docs, support, disclosure).dropDuplicates(["doc_id", "text_key"]).where(F.size("spans") > 0)
    found = staged(found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("spans").alias("_spans")), "spans")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(small(found), key.eqNullSafe(F.col("_text")) & docs["doc_id"].eqNullSafe(F.col("_id")), "left")
    text = F.when(F.col("_spans").isNull(), docs["text"]).otherwise(redacted(docs["text"], F.col("_spans")))
    return joined.select(*[text.alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns])
