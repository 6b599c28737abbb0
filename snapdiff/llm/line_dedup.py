"""Line dedup: an exact set-similarity join of lines that removes later matches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import whole_groups
from .common import let, most_frequent, small, staged
from .tokens import counts, mix, unmix, words

SIMILARITY = 0.8
RANKED = 1 << 16   # tokens ranked by their counts; a token beyond makes up less than 1 / RANKED of all
BLOCK_LINES = 1 << 14
# A set of tokens is named by a mixed sum of its token hashes and by two words in
# which each token flips one bit. The flipped words bound the overlap of two sets.
SET = ["key", "flip1", "flip2"]


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def tokens(line: str | None) -> set[bytes]:
    """The tokens of a line: its words, A-Z in lower case."""
    return set((line or "").encode().lower().split())


def frequent_tokens(docs: DataFrame, ranked: int = RANKED) -> np.ndarray:
    """Hashes of the most frequent tokens, rarest first; at most `ranked`.

    A task reports its own `ranked` most frequent tokens, so a token that makes up
    more than 1 / ranked of the corpus is reported by a task at least. The ranks
    only order the prefixes; any order gives the same matches.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, parts, size = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, each = (np.concatenate(x) for x in zip((seen, n), *parts))
            by = np.argsort(keys)
            starts = np.flatnonzero(np.r_[True, keys[by][1:] != keys[by][:-1]])
            keys, each = keys[by][starts], np.add.reduceat(each[by], starts)
            if len(keys) > 16 * ranked:
                top = np.argpartition(each, -8 * ranked)[-8 * ranked:]
                keys, each = keys[top], each[top]
            return keys, each

        for batch in batches:
            for found in words(batch["text"]):
                parts.append(counts(found.hash))
                size += len(parts[-1][0])
                if size > 32 * ranked:
                    (seen, n), parts, size = merged(), [], 0
        if parts:
            seen, n = merged()
        top = np.argsort(-n, kind="stable")[:ranked]
        yield pa.RecordBatch.from_arrays([pa.array(seen[top].view(np.int64)), pa.array(n[top])], ["token", "n"])

    counted = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = most_frequent(counted, ranked).select("token", "n").toArrow()  # bounded by `ranked`
    token, n = top["token"].to_numpy(), top["n"].to_numpy()
    return token[np.lexsort((token, n))].view(np.uint64)


def line_sets(docs: DataFrame, ranked: np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """A row per line with words: its document, number, set and rarest tokens (its prefix)."""
    order = docs.sparkSession.sparkContext.broadcast(ranked)  # at most RANKED numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_hash = np.argsort(order.value, kind="stable")
        sorted_hash = order.value[by_hash]
        place = np.r_[by_hash + (1 << _RARE), 0]
        head = np.searchsorted(sorted_hash, np.arange(1 << _HEAD, dtype=np.uint64) << np.uint64(64 - _HEAD))
        most = int(np.diff(np.r_[head, len(by_hash)]).max())  # hashes that share their first bits

        def rank(h: np.ndarray) -> np.ndarray:  # rare tokens by hash first, ranked ones after
            rare = (h >> np.uint64(64 - _RARE)).astype(np.int64)
            if not len(by_hash):
                return rare
            at = head[h >> np.uint64(64 - _HEAD)]
            hit = (sorted_hash.take(at, mode="clip") == h) & (at < len(by_hash))
            ranks = np.where(hit, place[at], rare)
            left = np.flatnonzero(~hit)
            for n in range(1, most):
                left = left[at[left] + n < len(by_hash)]
                same = sorted_hash[at[left] + n] == h[left]
                ranks[left[same]] = place[at[left[same]] + n]
                left = left[~same]
            return ranks

        for batch in batches:
            for found in words(batch["text"]):
                if not len(found.hash):
                    continue
                new = np.r_[True, (found.row[1:] != found.row[:-1]) | (found.line[1:] != found.line[:-1])]
                heads = np.flatnonzero(new)
                line, ranks = np.cumsum(new) - 1, rank(found.hash)
                by = np.argsort(line << (_RARE + 1) | ranks) if len(heads) < 1 << (62 - _RARE) else None
                if by is None or _mixed(line[by], ranks[by], found.hash[by]):
                    by = np.lexsort((found.hash, ranks, line))
                line, own = line[by], found.hash[by]
                once = np.r_[True, (line[1:] != line[:-1]) | (own[1:] != own[:-1])]
                line, own = line[once], own[once]  # by line, then by rarity, each token once
                starts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
                size = np.diff(np.r_[starts, len(line)])
                flip, high = np.uint64(1) << (own & np.uint64(63)), (own & np.uint64(64)) > 0
                sets = [np.add.reduceat(mix(own), starts),
                        np.bitwise_xor.reduceat(np.where(high, np.uint64(0), flip), starts),
                        np.bitwise_xor.reduceat(np.where(high, flip, np.uint64(0)), starts)]
                length = size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1
                at = np.arange(len(line)) - np.repeat(starts, size)
                prefix = own[at < np.repeat(length, size)].astype(np.uint32).view(np.int32)
                rows = pa.array(found.row[heads])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].cast(pa.int64()).take(rows), batch["text_key"].take(rows), pa.array(found.line[heads].astype(np.int32)),
                     *[pa.array(s.view(np.int64)) for s in sets], pa.array(size.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(prefix))],
                    ["doc_id", "text_key", "line", *SET, "size", "prefix"])

    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")).mapInArrow(
        run, "doc_id long, text_key long, line int, key long, flip1 long, flip2 long, size int, prefix array<int>")


_HEAD = 18  # first bits by which a ranked hash is looked up
_RARE = 40  # bits of a rare token's hash that order it


def _mixed(line: np.ndarray, ranks: np.ndarray, own: np.ndarray) -> bool:
    """Whether different tokens of a line share a rank, so that equal ones may lie apart."""
    return bool(((line[1:] == line[:-1]) & (ranks[1:] == ranks[:-1]) & (own[1:] != own[:-1])).any())


def _pairs(first: np.ndarray, second: np.ndarray, c: dict[str, np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of postings pass the length, positional and bit filters."""
    a, b = c["size"][first], c["size"][second]
    need = np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9)
    at, to = c["place"][first], c["place"][second]
    fits = np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9
    fits &= np.minimum(at, to) + np.minimum(a - at, b - to) >= need
    fits &= (a != b) | (need < a)  # sets of one size that must share all their tokens would be one set
    spare = (a + b - 2 * need).astype(np.int64)  # tokens that one of the sets may have alone
    fits[fits] = _differ(first[fits], second[fits], c) <= spare[fits]
    one = np.flatnonzero(fits & (spare == 1))
    fits[one] = _by_one(first[one], second[one], a[one] < b[one], c)
    return fits


def _by_one(first: np.ndarray, second: np.ndarray, up: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    """Whether the larger set can be the smaller one and a token: their sums then give that token's hash."""
    change = (c["key"][second] - c["key"][first]).view(np.uint64)
    token = unmix(np.where(up, change, ~change + np.uint64(1)))
    bit = np.uint64(1) << (token & np.uint64(63))
    high = (token & np.uint64(64)) > 0
    flips = [c[f][first] ^ c[f][second] for f in ("flip1", "flip2")]
    return (flips[0] == np.where(high, np.uint64(0), bit)) & (flips[1] == np.where(high, bit, np.uint64(0)))


def _differ(first: np.ndarray, second: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    """No more than the tokens that one set of the pair has alone."""
    return sum(np.bitwise_count(c[f][first] ^ c[f][second]).astype(np.int64) for f in ("flip1", "flip2"))


def _earliest(first: np.ndarray, second: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each later set's pairs the `limit` earliest, and whether it had more."""
    by = np.lexsort((first, second))
    first, second = first[by], second[by]
    starts = np.flatnonzero(np.r_[True, second[1:] != second[:-1]]) if len(second) else np.empty(0, np.int64)
    size = np.diff(np.r_[starts, len(second)])
    keep = np.arange(len(second)) - np.repeat(starts, size) < limit
    return first[keep], second[keep], np.repeat(size > limit, size)[keep]


def _after(group: np.ndarray, size: np.ndarray, similarity: float) -> np.ndarray:
    """How many of the next sets of a group are not too large to match each; both sorted by `group + size`."""
    last = np.searchsorted(group + size, group + np.floor(size / similarity + 1e-6).astype(np.int64), "right")
    return last - np.arange(len(size)) - 1


def _dense(x: np.ndarray) -> np.ndarray:
    """The number of smaller values, equal ones counted once."""
    by, out = np.argsort(x), np.empty(len(x), np.int64)
    out[by] = np.cumsum(np.r_[False, x[by][1:] != x[by][:-1]]) if len(x) else 0
    return out


def _that_can_match(found: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The postings that share a group with one of a fitting size, by group and order of lines, and their groups' numbers."""
    group = _dense(found["token"].astype(np.int64) << 32 | found["block"])
    size = found["size"].astype(np.int64)
    scale = int(size.max() / similarity) + 2
    by = np.argsort(group * scale + size)
    fits = _after(group[by] * scale, size[by], similarity) > 0
    by = by[fits | np.r_[False, fits[:-1]]]
    found, group = found[by], group[by]
    number = group * (len(by) + 1) + _dense(found["doc_id"])
    by = np.argsort(number)
    tied = number[by][1:] == number[by][:-1]
    tied = np.flatnonzero(np.r_[False, tied] | np.r_[tied, False]) if len(by) else by
    more = by[tied]  # lines of one document
    by[tied] = more[np.lexsort((found["key"][more], found["line"][more], number[more]))]
    return found[by], group[by]


def candidates_in(c: dict[str, np.ndarray], group: np.ndarray, similarity: float, limit: int) -> tuple[np.ndarray, ...]:
    """Earlier and later postings of every group, and whether a later one had more.

    `c` holds the columns of postings sorted by group and then by order of lines.
    Only open postings look for earlier ones, and stop when they have `limit`.
    """
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    out = []
    here = np.flatnonzero(np.repeat(sizes <= _SMALL, sizes))
    here = here[np.lexsort((c["size"][here], group[here]))]  # by size, so that those which can match stand together
    scale = int(c["size"].max() / similarity) + 2
    after, found = _after(group[here] * scale, c["size"][here], similarity), []
    flip = c["flip1"][here]
    spare = np.minimum(c["size"][here] * (1 / similarity - 1) + 1e-6, 64).astype(np.uint8)  # as in _pairs, for the largest set that fits
    for part in np.array_split(np.arange(len(here)), 1 + int(after.sum()) // _PAIRS):
        ends = np.cumsum(after[part])
        other = np.arange(after[part].sum()) + np.repeat(part + 1 - ends + after[part], after[part])
        near = np.flatnonzero(np.bitwise_count(np.repeat(flip[part], after[part]) ^ flip[other]) <= np.repeat(spare[part], after[part]))
        one, other = here[part[np.searchsorted(ends, near, "right")]], here[other[near]]
        first, second = np.minimum(one, other), np.maximum(one, other)
        ok = np.flatnonzero(c["open"][second])
        ok = ok[_pairs(first[ok], second[ok], c, similarity)]
        found.append((first[ok], second[ok]))
    out.append(_earliest(*(np.concatenate(x) for x in zip(*found)), limit))
    for start, size in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        waiting, had = start + np.flatnonzero(c["open"][start:start + size]), np.zeros(size, np.int64)
        found, more = [], np.zeros(size, bool)
        for at in range(start, start + size, _BLOCK):  # earlier postings by blocks, until all that wait have enough
            block = np.arange(at, min(at + _BLOCK, start + size))
            first, second = np.repeat(block, len(waiting)), np.tile(waiting, len(block))
            ok = first < second
            first, second = first[ok], second[ok]
            ok = _pairs(first, second, c, similarity)
            f, s, m = _earliest(first[ok], second[ok], limit)
            found.append((f, s))
            np.add.at(had, s - start, 1)
            more[s[m] - start] = True
            more[np.flatnonzero(had >= limit)] = True
            waiting = waiting[(had[waiting - start] < limit) & (waiting > block[-1])]
            if not waiting.size:
                break
        f, s = (np.concatenate(x) for x in zip(*found))
        out.append((f, s, more[s - start]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _search(dealt: DataFrame, similarity: float, limit: int) -> DataFrame:
    """Candidate pairs of sets that share a prefix token: the earlier, the later, and `token, size` where the later has more.

    `size` is the later set's; both are null where its candidates of this token are all here.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket",)):
            found, group = _that_can_match(_unpacked(table, _POSTING), similarity)
            if not len(found):
                continue
            c = {n: np.ascontiguousarray(found[n]) for n in (*SET, "token", "place")}
            plain = {n: c[n] for n in SET}
            c |= {f: c[f].view(np.uint64) for f in ("flip1", "flip2")}
            c |= {"open": c["place"] < 0, "place": (c["place"] & _PLACE).astype(np.int64), "size": found["size"].astype(np.int64)}
            first, second, more = candidates_in(c, group, similarity, limit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(plain[n][i]) for i in (first, second) for n in SET]
                + [pa.array(c[n][second], mask=~more) for n in ("token", "size")], [*_A, *_B, "token", "size"])

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in (*_A, *_B)) + ", token int, size long")


_SMALL = 512   # postings of a group whose pairs of fitting sizes are all looked at; larger groups stop early, by blocks
_BLOCK = 64
_PAIRS = 1 << 21
_A, _B = [f"{n}_a" for n in SET], [f"{n}_b" for n in SET]
# Postings are dealt as records, those of a bucket of groups in one row, so that Spark moves and sorts a row for many of them.
_POSTING = np.dtype([("token", np.int32), ("block", np.int32), ("line", np.int32), ("size", np.int32), ("place", np.int32),  # place: its sign says open
                     ("doc_id", np.int64), *((n, np.int64) for n in SET)])
_COUNT = np.dtype([("token", np.int32), ("n", np.int64)])
_PLACE = (1 << 31) - 1
_BUCKETS = 1 << 11
_BUCKET_SETS = 1 << 14  # where _BUCKETS of so many sets do not hold all, there are more
_DEALT = 1 << 20        # postings dealt at once


def _packed(bucket: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """A row `bucket, records` for each bucket; both come sorted by bucket."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    cuts = (np.r_[starts, len(bucket)] * records.itemsize).astype(np.int32)
    data = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(records)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), data], ["bucket", "records"])


def _unpacked(table: pa.Table, kind: np.dtype) -> np.ndarray:
    """The records of all rows of a table of `_packed` rows."""
    parts = []
    for chunk in table["records"].chunks:
        if len(chunk):
            cuts = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, 4 * chunk.offset)
            parts.append(np.frombuffer(chunk.buffers()[2], kind, (cuts[-1] - cuts[0]) // kind.itemsize, cuts[0]))
    return np.concatenate(parts)


def _by_bucket(group: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings the groups of a bucket together, and their buckets in that order."""
    bucket = (mix(group.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
    by = np.argsort(bucket, kind="stable")
    return by, bucket[by]


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def _hot_tokens(parts: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of more than BLOCK_LINES postings, in order, and the blocks of each; there is at most one for every BLOCK_LINES postings."""
    bound = BLOCK_LINES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, n = counts(batch["prefix"].flatten().to_numpy())
            if len(token):
                by, bucket = _by_bucket(token, buckets)
                records = np.empty(len(by), _COUNT)
                records["token"], records["n"] = token[by], n[by]
                yield _packed(bucket, records)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket",)):
            found = _unpacked(table, _COUNT)
            found = found[np.argsort(found["token"])]
            starts = np.flatnonzero(np.r_[True, found["token"][1:] != found["token"][:-1]])
            n, token = np.add.reduceat(found["n"], starts), found["token"][starts]
            yield pa.RecordBatch.from_arrays([pa.array(token[n > bound]), pa.array(-(-n[n > bound] // bound))], ["token", "blocks"])

    counted = _dealt(parts.select("prefix").mapInArrow(count, "bucket int, records binary"))
    hot = counted.mapInArrow(total, "token int, blocks long").toArrow().sort_by("token")
    return hot["token"].to_numpy(), hot["blocks"].to_numpy()


def _still_open(parts: DataFrame, rest: DataFrame, similarity: float) -> DataFrame:
    """The postings that sets of `rest` (`SET, token, size`) may still match, each as a part of its own.

    Only their tokens are looked at, and of these only sets whose size lets them match one that
    still looks. What is open later was open before, so each round reads what the one before left.
    """
    some = staged(rest.groupBy("token").agg(F.floor(F.min("size") * similarity - 1e-9).alias("least"),
                                            F.ceil(F.max("size") / similarity + 1e-9).alias("most")), "open-tokens")
    least, most = some.agg(F.min("least"), F.max("most")).first()
    rows = parts.where(F.col("size").between(least, most)).drop("open").withColumnRenamed("place", "_from").select(
        "*", F.posexplode("prefix").alias("_at", "_token"))
    near = (F.col("_token") == F.col("token")) & F.col("size").between(F.col("least"), F.col("most"))
    rows = rows.join(small(some), near).withColumns({"place": F.col("_from") + F.col("_at"), "prefix": F.array("token")})
    rows = staged(rows.drop("_from", "_at", "_token", "token", "least", "most"), "open-postings")
    marked = small(staged(rest.select(*SET).distinct().withColumn("open", F.lit(True)), "open-sets"))
    return rows.join(marked, SET, "left").withColumn("open", F.coalesce("open", F.lit(False)))


def _postings(parts: DataFrame) -> DataFrame:
    """The postings, one per set and prefix token, by buckets; tokens of many sets are dealt into pairs of blocks.

    A part holds prefix tokens of a set that stand together, and the place of their first.
    """
    buckets = max(_BUCKETS, parts.count() // _BUCKET_SETS)
    parts = parts.select(*SET, "doc_id", "line", "size", "open", "place", "prefix")
    hot = parts.sparkSession.sparkContext.broadcast(_hot_tokens(parts, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_token, hot_blocks = hot.value
        for batch in batches:
            c = {n: batch[n].to_numpy(zero_copy_only=False) for n in batch.schema.names if n != "prefix"}
            token, length = batch["prefix"].flatten().to_numpy(), np.diff(batch["prefix"].offsets.to_numpy())
            row = np.repeat(np.arange(len(length)), length)
            place = c["place"][row] + np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            blocks = np.ones(len(row), np.int64)
            if len(hot_token):
                at = np.minimum(np.searchsorted(hot_token, token), len(hot_token) - 1)
                blocks = np.where(hot_token[at] == token, hot_blocks[at], blocks)
            at = np.cumsum(blocks) // _DEALT
            for part in np.split(np.arange(len(row)), np.flatnonzero(at[1:] != at[:-1]) + 1):
                if not len(part):
                    continue
                every, block = part, np.zeros(len(part), np.int64)
                b = blocks[part]
                if b.max() > 1:  # a row for each pair of blocks that holds the set's own
                    other = np.arange(b.sum()) - np.repeat(np.cumsum(b) - b, b)
                    every, b = np.repeat(part, b), np.repeat(b, b)
                    own = (mix(c["key"][row[every]].view(np.uint64)) % b.astype(np.uint64)).astype(np.int64)
                    block = np.minimum(own, other) * b + np.maximum(own, other)
                by, bucket = _by_bucket(token[every].astype(np.int64) << 32 | block, buckets)
                every, records = every[by], np.empty(len(by), _POSTING)
                of_set = row[every]
                for n in ("doc_id", "line", "size", *SET):
                    records[n] = c[n][of_set]
                records["token"], records["block"] = token[every], block[by]
                records["place"] = np.where(c["open"][of_set], place[every] | ~_PLACE, place[every])
                yield _packed(bucket, records)

    return _dealt(parts.mapInArrow(run, "bucket int, records binary"))


def _tokens_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """`SET, tokens` (sorted hashes) of the needed sets, read from their first lines."""
    wanted = needed.groupBy("doc_id", "text_key").agg(F.collect_list("line").alias("_lines"))
    wanted = staged(wanted.toDF("_id", "_text", "_lines"), "wanted")
    found = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")).join(
        small(wanted), F.col("text_key").eqNullSafe(F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"text_key": [], "line": [], "tokens": []}
            for text, key, lines in zip(*(batch[n].to_pylist() for n in ("text", "text_key", "_lines"))):
                split = (text or "").split("\n")
                for n in lines:
                    out["text_key"].append(key)
                    out["line"].append(n)
                    out["tokens"].append(_hashes(list(tokens(split[n]))).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out["text_key"], pa.int64()), pa.array(out["line"], pa.int32()),
                                              pa.array(out["tokens"], pa.list_(pa.int64()))], list(out))

    read = found.select("text", "text_key", "_lines").mapInArrow(run, "text_key long, line int, tokens array<long>")
    own = needed.select("text_key", "line", *SET)
    return own.join(read.dropDuplicates(["text_key", "line"]), ["text_key", "line"]).select(*SET, "tokens").dropDuplicates(SET)


def similar_sets(docs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The sets that have an earlier set of at least this Jaccard similarity.

    Each set first meets its earliest candidates only, so a group of near copies
    gives links to its first members and not all its pairs. A set whose candidates
    fail comes again with more of them, in the end with all, but only among the
    tokens where it had more.
    """
    found, parts = None, sets.withColumns({"open": F.lit(True), "place": F.lit(0)})
    more = F.struct("token", "size")
    for limit in (2, 32, 1 << 62):
        pairs = staged(_search(_postings(parts), similarity, limit).groupBy(*_A, *_B).agg(
            F.collect_set(F.when(F.col("token").isNotNull(), more)).alias("more")), "pairs")
        ends = pairs.select(*[F.col(n).alias(k) for n, k in zip(_A, SET)]).union(pairs.select(*_B)).distinct()
        needed = parts.join(small(staged(ends, "ends")), SET).select(*SET, "doc_id", "text_key", "line")
        needed = staged(needed if found is None else needed.distinct(), "needed")
        texts = staged(_tokens_of(docs, needed), "tokens")
        both = pairs.join(texts.toDF(*_A, "tokens_a"), _A).join(texts.toDF(*_B, "tokens_b"), _B)
        shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
        alike = shared >= similarity * (F.size("tokens_a") + F.size("tokens_b") - shared) - 1e-9
        judged = staged(both.select(*[F.col(n).alias(k) for n, k in zip(_B, SET)], alike.alias("alike"), "more"), "judged")
        alike = judged.where("alike").select(*SET).distinct()
        found = alike if found is None else found.union(alike)
        rest = judged.where("not alike").select(*SET, F.explode("more").alias("more")).select(*SET, "more.*")
        rest = staged(rest.join(alike, SET, "left_anti").distinct(), "open")
        if not rest.count():
            break
        parts = _still_open(parts, rest, similarity)
    return found


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, ranked: int = RANKED) -> DataFrame:
    """`doc_id, text_key, lines`: the lines that an earlier line of the corpus matches.

    Lines are joined only with sets that occur twice or match an earlier one. Both sides of that
    join are plain tables, so that Spark can split a set which makes up a third of all lines.
    """
    lines = staged(line_sets(docs, frequent_tokens(docs, ranked), similarity), "line-sets")
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "line", "text_key")
    sets = staged(lines.groupBy(*SET).agg(F.min(place).alias("at"), F.any_value("size").alias("size"), F.any_value("prefix").alias("prefix"),
                                          F.count(F.lit(1)).alias("n")).select(*SET, "at.*", "size", "prefix", "n"), "sets")
    later = staged(similar_sets(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(_LAST))), sets.drop("n"), similarity).distinct(), "later")
    first = sets.select(*SET, F.col("doc_id").alias("_id"), F.col("line").alias("_line"), F.col("text_key").alias("_text"), "n")
    first = first.join(small(later.withColumn("_later", F.lit(True))), SET, "left").where("n > 1 or _later")
    first = staged(first.drop("n"), "repeated")
    again = ~(F.coalesce("doc_id", F.lit(_LAST)).eqNullSafe(F.col("_id")) & (F.col("line") == F.col("_line")) & (F.col("text_key") == F.col("_text")))
    gone = lines.drop("prefix").join(small(first), SET).where(again | F.col("_later").isNotNull())
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines"))


_LAST = (1 << 63) - 1  # stands for a null doc_id, which comes last


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, ranked: int = RANKED) -> DataFrame:
    """`docs` with `text` freed of lines that match an earlier line, and `n_removed`.

    Lines are cut at \\n; their tokens are distinct words, A-Z in lower case.
    Lines are ordered by doc_id (null last), then by number, then by their text's hash. A line
    goes if any earlier line, kept or not, has a Jaccard similarity of `similarity` or more.
    Blank lines stay. Null texts stay null. Rows equal in doc_id and text are one
    document and keep the same lines; different texts that share a doc_id, or have none, are
    different documents. Other columns stay, and existing `n_removed` is replaced.
    """
    gone = staged(removed_lines(docs, similarity, ranked), "removed").toDF("_id", "_text", "_gone")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    text = F.col("_row.text")
    joined = rows.join(small(gone), F.xxhash64(F.coalesce(text, F.lit(""))).eqNullSafe(F.col("_text"))
                       & F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left")
    kept = let(F.split(text, "\n"), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_gone")), lambda i: F.get(x, i)), "\n"))
    freed = joined.select("_row", F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("_kept"),
                          F.coalesce(F.size("_gone"), F.lit(0)).cast("int").alias("_n"))
    own = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("text", "n_removed")]
    return freed.toDF("_row", "_kept", "_n").select(*own, F.col("_kept").alias("text"), F.col("_n").alias("n_removed"))
