"""BPE encoding and decoding with a memory-mapped lexicon of frequent words."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import scratch_path, write_bytes
from .common import most_frequent, words
from .transducer import Transducer, build

VOCABULARY = "/opt/tokenizers/byte_bpe_50k"  # with .json and .tiktoken, at the same place on every node
LEXICON_WORDS = 1 << 16                      # the most frequent words of the corpus; others are merged exactly
SLICE_CHARS = 4_000_000                      # texts encoded together; bounds a task's memory of words

# Fixed value: the published split pattern of the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Blocks whose characters have one class in every Unicode version; other texts are split by the library itself.
SETTLED = re.compile("[\0-՗‐-⁠ぁ-ゖァ-ヺ一-龥가-힣]*")


class Vocabulary:
    """The token table and the exact merge of a single word."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(f"{path}.json")
        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.merge = tiktoken.Encoding("merge", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._pieces = regex.compile(SPLIT).findall
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def split(self, text: str) -> list[str]:
        """The words that merges stay within; special tokens are words of their own."""
        if self._special and any(s in text for s in self.special):
            return [w for part in self._special.split(text) for w in ([part] if part in self.special else self._split(part))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if SETTLED.fullmatch(text):
            return self._pieces(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, word: str) -> list[int]:
        return [self.special[word]] if word in self.special else self.merge(word)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _mapped(path: str) -> Transducer:
    return Transducer.open(path)


def lexicon(docs: DataFrame, path: str = VOCABULARY, size: int = LEXICON_WORDS) -> np.ndarray:
    """The transducer of the most frequent words, at most `size`, counted over all documents."""
    counted = docs.select(F.explode(words(docs["text"])).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequent = most_frequent(counted, size).select("word").collect()  # bounded by `size`
    known = vocabulary(path)
    pieces = {p for r in frequent for p in (*known.split(r.word), *known.split(" " + r.word)) if p not in known.special}
    return build({p.encode(): known.encode(p) for p in pieces})


def publish(spark: SparkSession, flat: np.ndarray) -> str:
    """Put the transducer in the shared folder; every executor fetches it as a local file to map."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    target = f"{scratch_path(spark, 'lexicon')}/{name}"
    write_bytes(spark, target, flat.tobytes())
    spark.sparkContext.addFile(target)
    return name


class Encoder:
    """Encodes slices of texts: words by the lexicon, unseen ones by exact merges."""

    def __init__(self, known: Vocabulary, held: Transducer) -> None:
        self.known, self.held = known, held

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        split = [self.known.split(t) for t in texts]
        own = list(set().union(*split))
        numbers = self.held.lookup([w.encode() for w in own])
        hit = numbers >= 0
        packed = dict(zip((w for w, h in zip(own, hit) if h), self.held.outputs(numbers[hit].tolist())))
        packed.update((w, np.array(self.known.encode(w), "<u4").tobytes()) for w, h in zip(own, hit) if not h)
        return [b"".join(map(packed.__getitem__, ws)) for ws in split]


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, path: str = VOCABULARY, size: int = LEXICON_WORDS, keep_ids: bool = True) -> DataFrame:
    """`doc_id, ids, n_tokens, ids_sha256, decoded, decoded_sha256` of every row.

    Null and empty texts have no ids. Special tokens written in a text become their
    ids, as the library does by default. Repeated rows are encoded alike; other
    columns are not read. Without `keep_ids` the ids and decoded texts stay in the
    tasks and only counts and digests are returned.
    """
    name = publish(docs.sparkSession, lexicon(docs, path, size))
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        encoder = Encoder(known, _mapped(SparkFiles.get(name)))
        for batch in batches:
            ids, at = batch["doc_id"].cast(pa.int64()), 0
            for texts in _slices([t or "" for t in batch["text"].to_pylist()]):
                packed = encoder.encode(texts)
                unpacked = [np.frombuffer(p, "<u4").tolist() for p in packed]
                decoded = [known.decode(i) for i in unpacked]
                columns = [ids.slice(at, len(texts)), pa.array([len(p) // 4 for p in packed], pa.int64()),
                           [hashlib.sha256(p).hexdigest() for p in packed],
                           [hashlib.sha256(d.encode()).hexdigest() for d in decoded]]
                columns += [pa.array(unpacked, pa.list_(pa.int32())), decoded] if keep_ids else []
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in columns],
                                                 [f.split()[0] for f in schema.split(", ")])
                at += len(texts)

    schema = fields + (", ids array<int>, decoded string" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`doc_id, text` from `doc_id, ids`; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            texts = [known.decode(i or []) for i in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
