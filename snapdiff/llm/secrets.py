"""Secret scans: patterns, and strings of sensitive contexts that a primed compressor cannot shorten."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, most_frequent

KINDS = ("assign", "access", "hex", "novel")  # the first three are fixed by the contract, in this order
NOVELTY = 0.6           # marginal compressed bytes per byte from which a string is reported
NEARBY = 512            # characters on either side that prime the compressor
IDENTIFIERS = 4096      # most frequent words of sensitive contexts in the dictionary
LINES = 3               # lines after one with a sensitive word that are its context as well

# Fixed values of the contract: patterns and least lengths.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What makes a line and those after it a sensitive context, in lower case.
SENSITIVE = (*_KEYS, "credential", "private key", "access key", "bearer", "passphrase", "authorization")
_SPELLINGS = "\n".join(w for k in SENSITIVE for w in (k.upper(), k.title(), k)).encode()  # the words themselves are not novel
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~!@#$%^&*?-]{12,}")
_DIGIT, _WORD = re.compile("[0-9]"), re.compile("[A-Za-z]+")
_BEGIN, _END = re.compile(r"-----BEGIN [^\n]*PRIVATE KEY"), "-----END "
_BODY = re.compile(r"\s*(?:[A-Za-z0-9+/=]*|[A-Za-z-]+:[^\n]*)\s*")  # of a key block without end

Span = tuple[str, int, int]


def base_spans(text: str, lower: str) -> list[Span]:
    """The spans of the patterns, in order of start and kind."""
    found: list[Span] = []
    if any(k in lower for k in _KEYS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def marginal_bytes(candidate: str, nearby: str, identifiers: bytes) -> int:
    """Compressed bytes that the candidate adds, once the compressor knows its surroundings."""
    known = nearby.encode()
    primer = zstandard.ZstdCompressionDict(identifiers + b"\n" + _SPELLINGS + b"\n" + known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=9, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)
    return len(packer.compress(known + candidate.encode())) - len(packer.compress(known))


def _wordlike(candidate: str) -> bool:
    """Whether it is spelled as words are; a rare word is as new to the compressor as a secret."""
    return not _DIGIT.search(candidate) and all(w.islower() or w.isupper() or w.istitle() for w in _WORD.findall(candidate))


def sensitive_lines(lines: list[str]) -> list[bool]:
    """Whether each line is near a sensitive word before it, or in the block of a private key."""
    marks, near, block = [], 0, False
    ends = [_END in line for line in lines]
    last = max((i for i, end in enumerate(ends) if end), default=-1)
    for i, line in enumerate(lines):
        if block:
            block = not ends[i] and (i < last or bool(_BODY.fullmatch(line)))
        lower = line.lower()
        near = LINES + 1 if any(k in lower for k in SENSITIVE) else near - 1
        began = _BEGIN.search(line)
        block = block or bool(began and _END not in line[began.end():])
        marks.append(near > 0 or block)
    return marks


def novel_spans(text: str, lower: str, known: list[Span], identifiers: bytes, novelty: float = NOVELTY) -> list[Span]:
    """Strings of sensitive contexts that no span covers and that the compressor cannot shorten."""
    if not any(k in lower for k in SENSITIVE):
        return []
    found, at = [], 0
    taken = sorted((a, b) for _, a, b in known)
    lines = text.split("\n")
    for line, sensitive in zip(lines, sensitive_lines(lines)):
        if sensitive:
            for m in _CANDIDATE.finditer(text, at, at + len(line)):
                a, b = m.span()
                while taken and taken[0][1] <= a:
                    taken.pop(0)
                if (taken and taken[0][0] < b) or _wordlike(m[0]):
                    continue
                nearby = text[max(0, a - NEARBY):a] + " " + text[b:b + NEARBY]
                if marginal_bytes(m[0], nearby, identifiers) >= novelty * len(m[0]):
                    found.append(("novel", a, b))
        at += len(line) + 1
    return found


def identifier_dictionary(docs: DataFrame, size: int = IDENTIFIERS) -> bytes:
    """The words most frequent in sensitive lines of the corpus and the lines after them, rarest first; at most `size` words."""
    pattern = "(?i)" + "|".join(SENSITIVE)
    lines = let(F.split("text", "\n"), lambda x: let(F.transform(x, lambda line: line.rlike(pattern)), lambda marks: F.filter(
        x, lambda line, i: F.array_contains(F.slice(marks, F.greatest(i - LINES + 1, F.lit(1)), F.least(i, F.lit(LINES)) + 1), True))))
    line = docs.where(F.col("text").rlike(pattern)).select(F.explode(lines).alias("line"))
    word = line.select(F.explode(F.regexp_extract_all("line", F.lit(r"[A-Za-z_]{3,40}"), F.lit(0))).alias("word"))
    counted = word.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    top = most_frequent(counted, size).collect()  # bounded by `size`
    return "\n".join(r.word for r in sorted(top, key=lambda r: (r.n, r.word))).encode()


def find_secrets(docs: DataFrame, novelty: float = NOVELTY) -> DataFrame:
    """`doc_id, spans` of every row: `kind, start, end` in code points by start, then kind.

    Base spans are the matches of the patterns; `novel` spans are strings of twelve
    or more characters that are not spelled as words, in a line with a sensitive word,
    the lines after it or the block of a private key. Null and empty texts have none. Repeated rows stay and get equal spans; other
    columns are not read.
    """
    identifiers = identifier_dictionary(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                text = text or ""
                lower = text.lower()
                known = base_spans(text, lower)
                spans = sorted(known + novel_spans(text, lower, known, identifiers, novelty), key=_order)
                out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(out, _SPANS)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
