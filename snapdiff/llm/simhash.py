"""SimHash near-duplicates: covering bit masks find every pair within the radius."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_ROWS, grouped
from .common import small, staged
from .components import components

SHINGLE = 4   # fixed by the contract
RADIUS = 4    # fixed by the contract
SEED = 42     # fixed by the contract
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: ASCII white space and letters only
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    ends = (ends - 1).tolist()
    spans = list(zip(starts, ends[shingle - 1:])) or [(0, len(joined))]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(spans), _CHUNK):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans[i:i + _CHUNK]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, text_key, fp` of every row; the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), batch["text_key"], pa.array(found.view(np.int64))], ["doc_id", "text_key", "fp"])

    return docs.select("doc_id", "text", _text_key(docs).alias("text_key")).mapInArrow(run, "doc_id long, text_key long, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """2^(radius+1) - 1 masks; any `radius` bit positions are all left out of one of them.

    Position i carries a non-zero vector over GF(2) of radius + 1 components, and
    mask v holds the positions whose vector has an odd product with v. The vectors
    of `radius` positions leave a non-zero v orthogonal to all of them.
    """
    top = (1 << (radius + 1)) - 1
    vector = [1 + i % top for i in range(64)]
    return [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() & 1) for v in range(1, top + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that join what all such links join; at most n - 1."""
    if len(members) <= 8:
        values = members.tolist()
        return [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= radius]
    links, rest = [], members
    while rest.size:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                queue.extend(rest[near])
                links.extend((int(at), int(x)) for x in rest[near])
                rest = rest[~near]
    return links


def _links(groups: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["members"]
            values, cuts = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            found = [x for i, j in zip(cuts, cuts[1:]) for x in forest(values[i:j], radius)]
            a, b = np.array(found, np.uint64).reshape(-1, 2).T.copy().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return groups.select("members").mapInArrow(run, "a long, b long")


def linked(distinct: DataFrame, radius: int = RADIUS, bound: int = BLOCK_ROWS) -> DataFrame:
    """`node, root` over distinct fingerprints `fp`, by the links within the radius."""
    tables = F.array(*[F.struct(F.lit(k).cast("byte").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for k, m in enumerate(masks(radius))])
    return components(_links(grouped(distinct.select("fp", F.inline(tables)), ["mask", "key"], "fp", bound), radius))


def _labelled(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """`doc_id, text_key, fp, root, component_id` of every row; the root tells components without doc_id apart."""
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = distinct.join(linked(distinct, radius).withColumnRenamed("node", "fp"), "fp", "left")
    labels = staged(labels.select("fp", "first", F.coalesce("root", "fp").alias("root")), "labels")
    least = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    named = staged(labels.join(least, "root").select("fp", "root", "component_id"), "named")
    return marked.join(small(named), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`doc_id, fp, component_id` of every row: the smallest doc_id reachable by links.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other. Texts shorter than a shingle are hashed whole. Repeated rows stay, one
    result each; a component that has no doc_id at all has a null id.
    """
    return _labelled(docs, shingle, radius).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of `docs`, all columns, of every component: the smallest doc_id, else a row without one.

    Rows of a component with equal doc_id are told apart by their text. Every component
    keeps a row, also if its first row shares its doc_id with that of another.
    """
    marked = staged(_labelled(docs, shingle, radius), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")))
    firsts = marked.groupBy("root").agg(first.alias("_first")).select("_first._id", "_first._text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text"))
    copies = marked.join(small(staged(firsts, "firsts")), same).groupBy("_id", "_text").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs["doc_id"].alias("_doc"), _text_key(docs).alias("_key"))
    stay = rows.join(small(staged(copies, "stay")), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text")))
    once = stay.where(~F.col("_repeated")).select("_row").union(
        stay.where("_repeated").dropDuplicates(["_id", "_text"]).select("_row"))
    return once.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
