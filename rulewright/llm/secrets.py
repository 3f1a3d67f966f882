"""Secret scans: patterns, and a test of how well a tokenizer compresses a string.

A byte-pair vocabulary spells words of natural text with few tokens; a random
string needs about one token for every two characters.  Candidate strings
(runs of the usual characters of keys) with few characters per token are
secrets, unless they are of a known harmless kind: digests of usual lengths,
UUIDs, numbers, and identifiers, that is words between separators or changes of
case which the vocabulary spells well by themselves.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Shortest candidate, and characters per token below which one counts as random.
MIN_CHARS = 20
MAX_RATIO = 2.2

# The kinds and patterns of the contract.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: The method's own kind, after the base kinds.
RANDOM = "random"

_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}")
_DIGEST_CHARS = re.compile(r"[0-9a-fA-F]+")
#: Lengths of hexadecimal CRC-64, MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests.
DIGEST_CHARS = (16, 32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: An identifier has letters between separators, and a short number at its end at most; what counts are its words.
_SHAPE = re.compile(r"[/_=+-]*[A-Za-z]+(?:[/_=+-]+[A-Za-z]+)*[/_=+-]*[0-9]{0,4}[/_=+-]*")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NUMBER = re.compile(r"[0-9=/+_-]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, in code points."""
    found = []
    if (":" in text or "=" in text) and any(w in low for low in [text.lower()] for w in _WORDS):
        # A match too short to count still takes its characters, so all matches are made before any is dropped.
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def known_kind(candidate: str) -> bool:
    """Digests of usual lengths, UUIDs and numbers."""
    return bool((len(candidate) in DIGEST_CHARS and _DIGEST_CHARS.fullmatch(candidate)) or _UUID.fullmatch(candidate) or _NUMBER.fullmatch(candidate))


def outside(spans: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those of `spans` that no stretch of `taken` covers; both by start."""
    out, k, start, end = [], 0, 0, 0
    for span in spans:
        while k < len(taken) and taken[k][0] <= span[0]:
            # Stretches that touch or overlap cover as one.
            start, end = (start, max(end, taken[k][1])) if taken[k][0] <= end else taken[k][:2]
            k += 1
        reach, j = end, k
        while j < len(taken) and taken[j][0] <= reach < span[1]:
            reach, j = max(reach, taken[j][1]), j + 1
        if not (start <= span[0] and span[1] <= reach):
            out.append(span)
    return out


class Scanner:
    """Finds secrets in texts with a tiktoken vocabulary."""

    def __init__(self, vocabulary: str, min_chars: int = MIN_CHARS, max_ratio: float = MAX_RATIO) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.candidate = _CANDIDATE if min_chars == MIN_CHARS else re.compile(rf"[A-Za-z0-9+/_=-]{{{min_chars},}}")
        self.max_ratio = max_ratio

    def inefficient(self, candidate: str) -> bool:
        return len(candidate) < self.max_ratio * len(self.encoding.encode_ordinary(candidate))

    def identifier(self, candidate: str) -> bool:
        """Whether a candidate's words, each by itself, have enough characters per token."""
        words = _WORD.findall(candidate) if _SHAPE.fullmatch(candidate) else []
        return bool(words) and sum(map(len, words)) >= self.max_ratio * sum(len(self.encoding.encode_ordinary(w)) for w in words)

    def random_spans(self, text: str) -> list[tuple[int, int, str]]:
        """Candidates that the vocabulary spells badly and that are of no known kind."""
        return [(m.start(), m.end(), RANDOM) for m in self.candidate.finditer(text) if self.inefficient(m[0]) and not known_kind(m[0]) and not self.identifier(m[0])]

    def scan(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """(base spans, all spans), each by start, then kind; a random string that base spans cover whole is no span of its own."""
        order = (*KINDS, RANDOM).index
        base = sorted(base_spans(text), key=lambda s: (s[0], order(s[2])))
        return base, sorted(base + outside(self.random_spans(text), base), key=lambda s: (s[0], order(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


_scanners: dict[str, Scanner] = {}


def scanner(vocabulary: str) -> Scanner:
    if vocabulary not in _scanners:
        _scanners[vocabulary] = Scanner(vocabulary)
    return _scanners[vocabulary]


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of `docs` (doc_id, text): counts of the base kinds, their digest, all spans, and the method's count.

    A null or empty text has no span: its counts are 0, `spans` is empty and
    `base_sha256` is that of the empty string.  Repeated rows are scanned each
    on its own; an empty table gives no rows; other columns are ignored.
    """

    def run(batches):
        find = scanner(vocabulary)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base, every = find.scan(text)
                kinds = [k for _, _, k in base]
                rows.append((doc, *map(kinds.count, KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every) - len(base)))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

    return common.texts(docs).mapInArrow(common.tidily(run), RESULT)


def without_secrets(docs: DataFrame, vocabulary: str, mark: str = "<secret>") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark` and `n_chars` set anew where that column exists; all rows and columns stay."""
    common.small_batches(docs.sparkSession)
    schema = docs.schema

    def run(batches):
        find = scanner(vocabulary)
        for batch in batches:
            k, columns = batch.schema.get_field_index("text"), list(batch.columns)
            clean = []
            for text in columns[k].to_pylist():
                if text:
                    _, spans = find.scan(text)
                    parts, at = [], 0
                    for a, b, _ in spans:
                        if b > at:
                            if a >= at:
                                parts += [text[at:a], mark]
                            at = b
                    text = "".join([*parts, text[at:]])
                clean.append(text)
            columns[k] = pa.array(clean, batch.schema.field(k).type)
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                columns[n] = pa.array([None if x is None else len(x) for x in clean], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(common.tidily(run), schema)
