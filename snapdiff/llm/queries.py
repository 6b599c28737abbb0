"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, conversation_repair, html_text, line_dedup, mixing, neighbours, periodic_runs, perplexity, pii, quality_rules, secrets, simhash, vector_dedup)
from .common import documents, let, shipping, words

WORD_SQL = r"[^\x20\x09-\x0D]+"


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


# The limited sources are those first by limit per weight; `level` is shared by the rest.
MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS text_md5 FROM {{docs}}),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
         CAST(source_size * 3 AS DOUBLE) AS most FROM by_source),
filled AS (
  SELECT *, ((SELECT sum(source_size) FROM by_source)
             - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
rates AS (
  SELECT source, source_size, least(most, weight * (SELECT max(level) FROM (
    SELECT level FROM filled WHERE weight * level <= most UNION ALL SELECT 0.0) AS l)) AS target FROM filled),
drawn AS (
  SELECT s.*, r.source_size, r.target, coalesce(r.target / nullif(CAST(r.source_size AS DOUBLE), 0), 0.0) AS rate,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || text_md5), 1, 13) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
copied AS (
  SELECT *, CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM drawn)
"""
OP2_SQL = MIX_SQL.format(docs="documents") + "SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied"


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return secrets.find_secrets(documents(spark, sf_dir)).select(
        "doc_id", *map(_count, secrets.KINDS[:3]), F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), keep_ids=False)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_removed", "text")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select("doc_id", *map(_count, pii.KINDS), F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        "vec_id", "n_links", "component_id", "kept")


def damaged(conversations: DataFrame) -> DataFrame:
    """A fifth of the turns lose or change something, by conv_id and turn; `copies` says how often a turn is there."""
    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(named("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair(damaged(conversations), F.col("copies"))


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _after(state: str, edits: str, cost: str, line: str = "''") -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{c: {state}.c + {cost}, a: {state}.a || '{edits}', t: {state}.t || {line}}} END"


def _if(condition: str, state: str) -> str:
    return f"CASE WHEN {condition} THEN {state} END"


_LINE = "chr(10) || role || ':' || text"
_AS = {"u": "chr(10) || 'user:' || text", "a": "chr(10) || 'assistant:' || text"}
_PUT = {"u": "chr(10) || 'user:'", "a": "chr(10) || 'assistant:'"}
# States by the last role initial so far (n: nothing); b* are those after insertions in front of a row.
OP12_SQL = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (
  SELECT * EXCLUDE (name), xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: CAST(ord(substr(name, CAST(i AS BIGINT), 1)) AS BIGINT))),
      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 20 AS fault
  FROM named, crc_table),
kept AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM kept),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM ordered),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal, max(i) AS last FROM judged GROUP BY conv_id),
search AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{c: CAST(0 AS BIGINT), a: '', t: ''}} AS n,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS u,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS a FROM counted
  UNION ALL
  SELECT conv_id, i, dn,
         CASE WHEN must THEN ds ELSE {_least("ds", _if("initial = 's'", _after("n", "K", "more", _LINE)))} END,
         CASE WHEN must THEN du ELSE {_least("du", *(x for b in ("n", "s", "ba") for x in (
             _if("initial = 'u'", _after(b, "K", "more", _LINE)), _after(b, "R", "more + 1", _AS["u"]))))} END,
         CASE WHEN must THEN da ELSE {_least("da", _if("initial = 'a'", _after("bu", "K", "more", _LINE)), _after("bu", "R", "more + 1", _AS["a"]))} END
  FROM (
    SELECT *, {_least("u", *(_after(x, "I", "5", _PUT["u"]) for x in ("n", "s", "a")))} AS bu,
           {_least("a", _after("u", "I", "5", _PUT["a"]), _after("n", "II", "10", _PUT["u"] + " || " + _PUT["a"]), _after("s", "II", "10", _PUT["u"] + " || " + _PUT["a"]))} AS ba,
           {", ".join(f"{_after(x, 'D', '2')} AS d{x}" for x in "nsua")}
    FROM (SELECT search.conv_id, judged.i, n, s, u, a, role, text, initial, judged.fault IN ('blank', 'duplicate') AS must,
                 CASE WHEN judged.fault = 'truncated' THEN 5 ELSE 0 END AS more
          FROM search JOIN judged ON search.conv_id IS NOT DISTINCT FROM judged.conv_id AND judged.i = search.i + 1))),
solved AS (
  SELECT search.conv_id, {_least("n", "a", _after("u", "I", "5", _PUT["a"]), _after("s", "II", "10", _PUT["u"] + " || " + _PUT["a"]))} AS best
  FROM search JOIN counted ON search.conv_id IS NOT DISTINCT FROM counted.conv_id AND search.i = counted.last)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN counted ON c.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN solved ON c.conv_id IS NOT DISTINCT FROM solved.conv_id
"""


def looped(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, by doc_id, repeat some of their words up to their end; rows without doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(w: Column) -> Column:
        n = F.size(w)
        at = F.pmod(g, n)
        place = F.struct(at.alias("a"), (1 + F.floor((n - at) / (3 + g % 8))).cast("int").alias("p"))
        return let(place, lambda x: F.array_join(F.transform(w, lambda word, i: F.when(i < x["a"], word).otherwise(
            F.get(w, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " "))

    text = F.when(h % 10 == 0, let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise("")))
    return docs.withColumn("text", text.otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(looped(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _stop_sql() -> str:
    return " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in listed)}]"
                    for lang, listed in quality_rules.STOP_WORDS.items())


OP10_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, CASE lang {_stop_sql()} END AS stop,
         regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD_SQL}')) AS lines
  FROM documents),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM base),
grams AS (
  SELECT r, i, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3
  FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS n FROM grams WHERE w3 IS NOT NULL) AS g
  WHERE n > 1),
repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) AS c GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_extract_all(t, '!')) AS shouts, len(regexp_extract_all(t, '\p{{Lu}}')) AS capitals, len(lines) AS n_lines,
         CASE WHEN stop IS NOT NULL THEN len(list_filter(w, lambda x: list_contains(stop, lower(x)))) END AS stops
  FROM base LEFT JOIN repeated USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2.0 * n_words AND 14.0 * n_words AND n_symbols / n_words <= 0.10
       AND shouts / n_words <= 0.10 AND capitals / word_chars <= 0.30 AND coalesce(stops / n_words >= 0.02, true)
       AND n_dup_lines / n_lines <= 0.50 AS kept
FROM judged
"""

QUERIES = {
    "op1_perplexity": (op1_perplexity, None),
    "op2_mix_sources": (op2_mix_sources, OP2_SQL),
    "op3_secrets": (op3_secrets, None),
    "op4_bpe": (op4_bpe, None),
    "op5_simhash": (op5_simhash, None),
    "op6_line_dedup": (op6_line_dedup, None),
    "op7_neighbours": (op7_neighbours, None),
    "op8_html_text": (op8_html_text, None),
    "op9_pii": (op9_pii, None),
    "op10_quality_rules": (op10_quality_rules, OP10_SQL),
    "op11_vector_dedup": (op11_vector_dedup, None),
    "op12_conversation_repair": (op12_conversation_repair, OP12_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
QUERIES = {name: (shipping(run), sql) for name, (run, sql) in QUERIES.items()}
