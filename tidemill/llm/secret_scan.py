"""Operator 8: secret scans with a token-efficiency test.

Fixed patterns give the base spans (assignments of passwords and tokens,
access keys, hexadecimal runs).  The method adds ``random`` spans: runs of
12 and more key-like characters that a public byte-pair vocabulary can't
shorten, with few characters for each token, since natural words and names
merge into long tokens and random strings don't.  Words of letters in one
case, alone or joined by punctuation, must besides be far likelier as
independent letters than by the letter pairs of the vocabulary's own tokens,
so that rare words and compounds aren't reported.

Excluded are known digests (hexadecimal of a digest's length) and identifiers
(UUIDs, numbers, times, hosts of addresses, short words joined by
punctuation).  A run ends at ``name=`` and is cut around base spans; of a
path the segments are asked for, without the words that lead to them, those
of web addresses too.

Each text is scanned whole, within one Arrow batch; there is no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import map_batches, text_or_empty, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
RUN = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}")
LEAST = 12
# fixed values: characters of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512)
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile(rb"[0-9a-fA-F]+")
UUID = re.compile(rb"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
NUMBER_LIKE = re.compile(rb"[0-9+/_=-]+")
TIME_LIKE = re.compile(rb"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2,6}Z?")
# words, years and small numbers joined by punctuation: slugs, file names, options
JOINED = re.compile(rb"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4})(?:[+/_=-]+(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4}))*[+/_=-]*")
SHORT_NAME = re.compile(rb"[A-Za-z0-9]{0,2}")
LONG_WORD = re.compile(rb"[A-Za-z]{12,}")
PUNCTUATION = re.compile(rb"[+/_=-]")
UNLIKELY_WORD = -20.0  # bits: letters that are a million times likelier independent than by the vocabulary's letter pairs
# what leads to a host or path segment of an address: nothing that ends an address or begins user-info or a query
PART_OF_ADDRESS = re.compile(rb"(?::/|www\.|@)([^\s:?#@,;&|=\"'`()<>\[\]{}\\]*(?::[0-9]{1,5}/[^\s:?#@,;&|=\"'`()<>\[\]{}\\]*)?)$")
BEFORE_PORT = re.compile(rb"(?::/|www\.|@)[/A-Za-z0-9._-]+:$")
PORT = re.compile(rb"[0-9]{1,5}/")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=1)
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secret-scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def letter_pairs(path: str) -> list[list[float]]:
    """Bits by which a letter after another (0: the word's beginning) is likelier in the vocabulary's tokens than any letter."""
    counts = [[1.0] * 27 for _ in range(27)]
    for token in encoding(path).token_byte_values():
        word = token.strip().lower()
        if len(word) > 2 and word.isalpha() and word.isascii():
            last = 0
            for c in word:
                counts[last][c - 96] += 1
                last = c - 96
    bits = [[math.log2(26 * n / (sum(row) - row[0])) for n in row] for row in counts]
    for i in range(27):
        bits[i][i] = 0.0  # a letter again and again speaks for neither
    return bits


def word_bits(word: bytes, vocabulary: str) -> float:
    """By how many bits a word's letter pairs are likelier in the vocabulary than independent letters."""
    pairs, letters = letter_pairs(vocabulary), [c - 96 for c in word.lower()]
    return sum(pairs[a][b] for a, b in zip([0, *letters], letters))


def known_identifier(run: bytes) -> bool:
    core = run.strip(b"=/+_-")
    return (len(core) in DIGEST_LENGTHS and DIGEST.fullmatch(core) is not None or UUID.fullmatch(core) is not None
            or NUMBER_LIKE.fullmatch(core) is not None or TIME_LIKE.fullmatch(core) is not None)


def is_random(run: bytes, vocabulary: str, most_chars: float) -> bool:
    """Whether the vocabulary can't shorten a run; words joined by punctuation are asked for one by one."""
    def inefficient(part: bytes) -> bool:
        return len(part) < most_chars * len(encoding(vocabulary).encode_ordinary(part.decode("ascii")))
    if known_identifier(run) or 4 * len(PUNCTUATION.findall(run)) > len(run):
        return False
    if JOINED.fullmatch(run.strip(b"=/+_-")):
        return any(inefficient(w) and word_bits(w, vocabulary) < UNLIKELY_WORD for w in LONG_WORD.findall(run))
    return inefficient(run)


def segments(run: bytes, start: int) -> list[tuple[int, int]]:
    """The places between a run's slashes, empty ones too; ``start`` is the run's own place."""
    out, at = [], start
    for part in run.split(b"/"):
        out.append((at, at + len(part)))
        at += len(part) + 1
    return out


def parts_of_address(text: bytes, start: int, end: int) -> list[tuple[int, int]] | None:
    """The path segments of a run inside a web or mail address, without its host; None for a run that is in none.

    User-info and query values are no parts of an address in this sense.
    """
    if b"/" not in text[start:end] and text[end:end + 1] == b"@":
        return None
    before = text[max(0, start - 200):start]
    places = segments(text[start:end], start)
    if before.endswith(b":") and text.startswith(b"//", start):
        user = text[end:end + 1] == b"@" or re.match(rb":[^\s/@]*@", text[end:end + 200]) is not None
        return places[2 if user else 3:]
    m = PART_OF_ADDRESS.search(before)
    if m:
        return places[0 if b"/" in m[1].removeprefix(b"/") else 1:]
    if PORT.match(text, start, end) and BEFORE_PORT.search(before):
        return places[1:]
    return None


def random_parts(text: bytes, start: int, end: int, vocabulary: str, most_chars: float) -> list[tuple[int, int]]:
    """The places of a run that are random: a key as a whole, slashes included, or segments of a path."""
    def random(s: int, e: int) -> bool:
        return e - s >= LEAST and is_random(text[s:e], vocabulary, most_chars)
    if known_identifier(text[start:end]):
        return []
    places = parts_of_address(text, start, end)
    if places is None:
        places = segments(text[start:end], start)

        def name(place: tuple[int, int]) -> bool:
            part = text[place[0]:place[1]]
            return SHORT_NAME.fullmatch(part) is not None or JOINED.fullmatch(part) is not None and not random(*place)
        if len(places) > 1:
            while places and name(places[0]):
                places.pop(0)
            while places and name(places[-1]):
                places.pop()
        if places and places[-1][1] - places[0][0] >= 10 * (len(places) - 1) and random(places[0][0], places[-1][1]):
            return [(places[0][0], places[-1][1])]
    return [p for p in places if random(*p)]


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes; what fails a kind's length is dropped after it has been consumed."""
    out = []
    if b"=" in text or b":" in text:
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def random_spans(text: bytes, base: list[tuple[int, int, int]], vocabulary: str, most_chars: float) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    taken, i = sorted((s, e) for s, e, _ in base), 0
    for m in RUN.finditer(text):
        start, end = m.span()
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        # what base spans leave of the run; spans of different kinds may overlap
        rest, j, at = [], i, start
        while j < len(taken) and taken[j][0] < end:
            rest.append((at, taken[j][0]))
            at, j = max(at, taken[j][1]), j + 1
        rest.append((at, end))
        if len(rest) > 1 and known_identifier(m[0]):
            continue
        for s, e in rest:
            if e - s >= LEAST:
                out += [(*p, 3) for p in random_parts(text, s, e, vocabulary, most_chars)]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if text.isascii() or not spans:
        return spans
    ends = sorted({x for s, e, _ in spans for x in (s, e)})
    at, last, count = {}, 0, 0
    for x in ends:  # each stretch of text is decoded once
        count += len(text[last:x].decode("utf-8"))
        at[x], last = count, x
    return [(at[s], at[e], k) for s, e, k in spans]


def scan(docs: DataFrame, vocabulary: str | None = None, most_chars: float = 2.0) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then
    kind, joined by commas; ``base_sha256`` digests those of the base kinds
    alone.  ``most_chars`` is the number of characters for each token below
    which a run is random.  Null and empty texts have no spans (the digest of
    the empty string).  Repeated rows and null ids are scanned like others;
    an empty table gives an empty result; only doc_id and text are read.
    """
    path = vocabulary or default_vocabulary()

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in texts_of(b.column(1)):
            base = base_spans(t)
            every = sorted(base + random_spans(t, base, path, most_chars), key=lambda s: (s[0], s[2]))
            every = in_code_points(t, every)
            base = [s for s in every if s[2] < 3]
            n = [sum(s[2] == k for s in every) for k in range(4)]
            rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([b.column(0), *[pa.array(list(c), t) for c, t in zip(cols, kinds)]],
                                          names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), run,
                       "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
