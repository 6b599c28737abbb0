"""Quality classifier: interpolated modified Kneser-Ney over characters, trained on trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, staged
from .tokens import mix

ORDER = 5              # characters of an n-gram
QUANTILE = 0.995       # of the held-out trusted documents of a language
FOLDS = 5              # parts of the trusted texts, by hash; each is scored by a model of the others
MODEL_ROWS = 4_000_000  # n-grams that may be broadcast; beyond it blocks of documents are joined with theirs
BLOCK_CHARS = 32_000_000
PIECE_CHARS = 1 << 20  # a longer text is worked on in pieces
_START = "\2" * (ORDER - 1)
_MERGE = 2_000_000     # n-grams that a task holds before it sends them on
_COUNTED = 1 << 30     # and characters, so that 32 bits hold every count

_MODELS = ("", *map(str, range(FOLDS)))  # endings of columns: of all trusted text, and without each fold
_PARTS = [f"part{k}" for k in range(FOLDS)]
_FIELDS = f"lang string, gram string, key long, {', '.join(f'{c} int' for c in _PARTS)}"


class _Piece:
    """The n-grams of some texts: places, documents and 64-bit keys."""

    def __init__(self, rows: list[int], texts: list[str], langs: np.ndarray) -> None:
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").copy()
        self.points[self.points == 0] = 0xFFFD
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        inside = np.ones(len(self.points), bool)
        inside[(ends[:, None] - np.arange(1, ORDER)).ravel()] = False
        self.starts = np.flatnonzero(inside)
        self.row = np.repeat(np.array(rows), sizes - (ORDER - 1))
        h = np.zeros(len(self.starts), np.uint64)
        for k in range(ORDER):
            h = mix(h + self.points[self.starts + k].astype(np.uint64) + np.uint64(k + 1))
        self.key = mix(h ^ langs[self.row])

    def grams(self, places: np.ndarray) -> np.ndarray:
        return self.points[self.starts[places][:, None] + np.arange(ORDER)].astype("<u4").view(f"<U{ORDER}").ravel()


def _pieces(texts: list[str], langs: np.ndarray) -> Iterator[_Piece]:
    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), PIECE_CHARS):
            rows.append(row)
            held.append((_START if not at else text[at - ORDER + 1:at]) + text[at:at + PIECE_CHARS])
            size += len(held[-1])
            if size >= PIECE_CHARS:
                yield _Piece(rows, held, langs)
                rows, held, size = [], [], 0
    if rows:
        yield _Piece(rows, held, langs)


def _lang_hash(langs: list[str]) -> np.ndarray:
    known = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _runs(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """`lang, gram, key, n, n0, ...` of every n-gram of `lang, text, train` and, if there is one, `fold`.

    n counts the training texts, n0 those outside fold 0, and so on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            keys, counts, grams, named = zip(*held)
            key = np.concatenate(keys)
            by = np.argsort(key)
            starts = _runs(key[by])
            first, n = by[starts], np.empty((len(starts), FOLDS), np.int32)
            for k in range(FOLDS):  # by column: the counts are the largest part of what a task holds
                n[:, k] = np.add.reduceat(np.concatenate([c[:, k] for c in counts])[by], starts)
            return key[first], n, np.concatenate(grams)[first], np.concatenate(named)[first]

        def sent(key: np.ndarray, n: np.ndarray, gram: np.ndarray, lang: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(lang.tolist(), pa.string()), pa.array(gram.tolist(), pa.string()), pa.array(key.view(np.int64)),
                 *[pa.array(np.ascontiguousarray(c)) for c in n.T]], ["lang", "gram", "key", *_PARTS])

        size = counted = 0
        for batch in batches:
            names = batch["lang"].to_pylist()
            langs, folds = _lang_hash(names), batch["fold"].to_numpy()
            named = np.array(names, object)
            for piece in _pieces(batch["text"].to_pylist(), langs):
                by = np.argsort(piece.key)
                starts = _runs(piece.key[by])
                first = by[starts]
                fold, group = folds[piece.row][by], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(by)]))
                trained = fold >= 0
                n = np.bincount(group[trained] * FOLDS + fold[trained], minlength=len(starts) * FOLDS).reshape(-1, FOLDS).astype(np.int32)
                held.append((piece.key[first], n, piece.grams(first), named[piece.row[first]]))
                size += len(first)
                counted += len(by)
                if size > _MERGE or counted > _COUNTED:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > _MERGE // 2 or counted > _COUNTED:
                        yield sent(*held[0])
                        held, size, counted = [], 0, 0
        if held:
            yield sent(*merged())

    fold = F.col("fold") if "fold" in docs.columns else F.lit(0)
    sent = docs.select("lang", "text", F.when(F.col("train"), fold).otherwise(-1).cast("int").alias("fold")).mapInArrow(run, _FIELDS)
    summed = sent.groupBy("lang", "gram").agg(F.first("key").alias("key"), *[F.sum(c).alias(c) for c in _PARTS])
    n = sum((F.col(c) for c in _PARTS[1:]), F.col(_PARTS[0]))
    return summed.select("lang", "gram", "key", n.alias("n"), *[(n - F.col(c)).alias(f"n{k}") for k, c in enumerate(_PARTS)])


def _discount(m: str) -> Column:
    c = F.col(f"n{m}")
    return F.when(c == 1, F.col(f"d1_{m}")).when(c == 2, F.col(f"d2_{m}")).when(c > 2, F.col(f"d3_{m}")).otherwise(0.0)


def _level(held: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """Probabilities of all n-grams `lang, gram, n, n0, ...` of one order, by joins of counts sharded by n-gram.

    `n` is the count at the highest order and below it the number of different
    n-grams one longer that were seen to end so. The models without a fold judge
    n-grams of trusted text only.
    """
    seen = held.where("n > 0")

    def part(m: str, i: int) -> Column:  # no less than none and no more than the count itself
        rate = F.coalesce(F.try_divide(F.col(f"c1_{m}"), F.col(f"c1_{m}") + 2 * F.col(f"c2_{m}")), F.lit(0.5))
        more = F.coalesce(F.try_divide(F.col(f"c{i + 1}_{m}"), F.col(f"c{i}_{m}")), F.lit(1.0))
        return F.least(F.greatest(i - (i + 1) * rate * more, F.lit(0.0)), F.lit(float(i))).alias(f"d{i}_{m}")

    of = [F.sum(F.when(F.col(f"n{m}") == i, 1).otherwise(0)).cast("double").alias(f"c{i}_{m}") for m in _MODELS for i in (1, 2, 3, 4)]
    kinds = [F.nullif(F.sum(F.when(F.col(f"n{m}") > 0, 1).otherwise(0)), F.lit(0)).alias(f"kinds{m}") for m in _MODELS]
    discounts = seen.groupBy("lang").agg(*of, *kinds).select(
        "lang", *[f"kinds{m}" for m in _MODELS], *[part(m, i) for m in _MODELS for i in (1, 2, 3)])
    discounts = small(staged(discounts, "discounts"))
    prefix = F.substring("gram", 1, order - 1).alias("prefix")
    context = seen.join(discounts, "lang").select(
        "lang", prefix, *[f"n{m}" for m in _MODELS], *[_discount(m).alias(f"left{m}") for m in _MODELS])
    context = context.groupBy("lang", "prefix").agg(
        *[F.nullif(F.sum(f"n{m}"), F.lit(0)).alias(f"total{m}") for m in _MODELS], *[F.sum(f"left{m}").alias(f"left{m}") for m in _MODELS])
    rows = held.withColumn("prefix", prefix).join(context, ["lang", "prefix"], "left").join(discounts, "lang", "left")
    if lower is None:
        rows = rows.withColumns({f"back{m}": 1.0 / (F.col(f"kinds{m}") + 1) for m in _MODELS})
    else:
        below = lower.select("lang", F.col("gram").alias("suffix"), *[F.col(f"p{m}").alias(f"back{m}") for m in _MODELS])
        rows = rows.withColumn("suffix", F.substring("gram", 2, order - 1)).join(below, ["lang", "suffix"], "left")

    def probability(m: str) -> Column:
        n, total, back = F.col(f"n{m}"), F.col(f"total{m}"), F.col(f"back{m}").cast("double")
        own = F.greatest(n - _discount(m), F.lit(0.0)) / total + F.col(f"left{m}") / total * back
        p = F.when(total.isNull(), back).otherwise(own)
        return (F.when(F.col("n") > 0, p).cast("float") if m else p).alias(f"p{m}")

    kept = [c for c in ("key",) if c in held.columns]
    return rows.select("lang", "gram", *kept, *map(probability, _MODELS))


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """`lang, gram, key, p, p0, ...` for every n-gram of the corpus; null in a language without training text."""
    tables = [counts]
    for k in range(order - 1, 0, -1):
        above = tables[-1]
        tables.append(staged(above.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
            *[F.sum(F.when(F.col(f"n{m}") > 0, 1).otherwise(0)).alias(f"n{m}") for m in _MODELS]), "types"))
    p = None
    for k, table in enumerate(reversed(tables), 1):
        p = staged(_level(table, p, k), "level")
    return p


def _scored(batch: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
    """Of each text the sums of log probabilities, of all trusted text and without its own fold, and the characters."""
    total, outside, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
    folds = batch["fold"].to_numpy()
    for piece in _pieces(batch["text"].to_pylist(), _lang_hash(batch["lang"].to_pylist())):
        by = np.argsort(piece.key)
        starts = _runs(piece.key[by])
        found = np.minimum(np.searchsorted(keys, piece.key[by][starts]), len(keys) - 1)
        at = np.empty(len(by), np.int64)
        at[by] = np.repeat(found, np.diff(np.r_[starts, len(by)]))
        total += np.bincount(piece.row, logs[at, 0], batch.num_rows)
        n += np.bincount(piece.row, minlength=batch.num_rows)
        fold = folds[piece.row]
        own = np.flatnonzero(fold >= 0)
        outside += np.bincount(piece.row[own], logs[at[own], fold[own] + 1], batch.num_rows)
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], batch["lang"], batch["fold"], pa.array(total), pa.array(outside), pa.array(n)],
        ["doc_id", "lang", "fold", "logp", "outside", "n"])


def _table(grams: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ordered keys, and the log probabilities of every model."""
    keys = grams["key"].to_numpy().view(np.uint64)
    by, logs = np.argsort(keys), np.empty((len(keys), len(_MODELS)), np.float32)
    for k, m in enumerate(_MODELS):
        logs[:, k] = grams[f"logp{m}"].to_numpy()[by]
    return keys[by], logs


_SCORED = "doc_id long, lang string, fold int, logp double, outside double, n long"


def score(docs: DataFrame, model: DataFrame, most: int = MODEL_ROWS) -> DataFrame:
    """Log probabilities and characters of every row of `doc_id, lang, text, fold`; the fold is -1 for other texts.

    A model of at most `most` n-grams is broadcast. A larger one meets the
    documents in blocks: each block asks for its own n-grams and is joined with them.
    """
    logs = model.select("key", *[F.log(f"p{m}").cast("float").alias(f"logp{m}") for m in _MODELS])
    rows = docs.select("doc_id", "lang", "text", "fold")
    if logs.count() <= most:
        shared = docs.sparkSession.sparkContext.broadcast(_table(logs.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _scored(batch, *shared.value)

        return rows.mapInArrow(run, _SCORED)

    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, int(chars) // BLOCK_CHARS))).alias("block")
    blocked = rows.withColumn("block", block)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch["block"].to_numpy()
            for piece in _pieces(batch["text"].to_pylist(), _lang_hash(batch["lang"].to_pylist())):
                by = np.lexsort((piece.key, blocks[piece.row]))
                key, own = piece.key[by], blocks[piece.row][by]
                new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
                yield pa.RecordBatch.from_arrays([pa.array(own[new]), pa.array(key[new].view(np.int64))], ["block", "key"])

    asked = blocked.select("block", "lang", "text").mapInArrow(ask, "block long, key long").distinct().join(logs, "key")

    def judge(docs_of: pa.Table, grams: pa.Table) -> pa.Table:
        keys, own = _table(grams)
        return pa.Table.from_batches([_scored(b, keys, own) for b in docs_of.drop(["block"]).to_batches()])

    return blocked.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(judge, _SCORED)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most: int = MODEL_ROWS) -> DataFrame:
    """`doc_id, lang, n_chars, perplexity, threshold, kept` of every row of `docs`.

    Trusted documents are those whose labels all say quality 1, and they train the
    model of their language. Their texts are dealt into folds; each fold is scored by
    a model of the others, and the quantile of these perplexities is the threshold of
    the language, however few they are. A null language is one of its own. Texts
    without characters, and languages without trusted text, have no perplexity and
    are kept; a language with a single trusted text has no threshold, so its
    documents are kept as well. Repeated rows are judged alike.
    """
    trusted = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("_q"))
    trusted = staged(trusted.where("_q = 1").select(F.col("doc_id").alias("_id")), "trusted")
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["lang"], F.lit("")).alias("lang"), text.alias("text"))
    known = rows.join(small(trusted), rows["doc_id"] == F.col("_id"), "left")
    own_hash, train = F.xxhash64("text"), F.col("_id").isNotNull()
    fold = F.pmod(own_hash, F.lit(FOLDS)).cast("int")
    dealt = known.where(train & (F.col("text") != "")).select("lang", own_hash.alias("h"), fold.alias("fold")).groupBy("lang").agg(
        F.when(F.min("fold") == F.max("fold"), F.min("h")).alias("_moved"))  # if one fold got all, one text moves to the next
    known = known.join(small(staged(dealt, "dealt")), "lang", "left")
    fold = F.when(F.coalesce(own_hash == F.col("_moved"), F.lit(False)), (fold + 1) % FOLDS).otherwise(fold)
    marked = known.select("doc_id", "lang", "text", train.alias("train"), F.when(train, fold).otherwise(-1).alias("fold"))
    model = probabilities(staged(gram_counts(marked), "counts"))
    n = F.nullif(F.col("n"), F.lit(0))
    scored = score(marked, model, most).withColumns({"perplexity": F.exp(-F.col("logp") / n), "outside": F.exp(-F.col("outside") / n)})
    scored = staged(scored.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("perplexity", "outside")}), "scored")
    cut = F.percentile_approx("outside", quantile, 10_000).alias("threshold")
    own = scored.where("fold >= 0 AND outside IS NOT NULL").groupBy("lang").agg(cut)
    judged = scored.join(small(staged(own, "cuts")), "lang", "left")
    return judged.select("doc_id", F.nullif("lang", F.lit("")).alias("lang"), F.col("n").alias("n_chars"), "perplexity",
                         "threshold", (F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"))
