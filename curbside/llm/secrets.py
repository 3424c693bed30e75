"""Secrets by patterns and by dictionary-primed compression novelty.

Fixed patterns give the base spans. Further candidates are long unbroken strings near a word that speaks of secrets.
A candidate's novelty is the number of bytes by which it lengthens a zstandard frame of the text around it, primed with
code words and with identifiers that the corpus repeats away from sensitive words: parts of names and paths are nearly
free, a random string costs most of its bits again. Candidates that are no identifier themselves and whose marginal
bytes per character reach a threshold are reported as kind `novel`.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.common import unused
from curbside.session import settle

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same matches as of [0-9a-f]+ with 32 characters or more
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "novel")

# Candidates of the method: at least this long, with a digit and a letter, this near to a sensitive word.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
SENSITIVE = re.compile(r"passw|secret|token|api_?key|credential|bearer|private|auth|akia|pwd", re.IGNORECASE | re.ASCII)
REACH = 80
NOVELTY = 0.55  # marginal compressed bytes per character; random hexadecimal costs 0.5, random base64 0.75
SECRET_SHAPE = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])")

# Words of program text that are no secrets, to prime the dictionary with.
CODE_WORDS = (
    "import from return function class public static private const string integer boolean value values name key keys "
    "token tokens secret secrets password passwd credential credentials authorization bearer header headers request "
    "response client server config configuration settings environment variable default example test placeholder "
    "http:// https:// www. .com .org .net /usr/local/lib/ /home/ node_modules abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 00000000000000000000000000000000 "
    "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx your_api_key_here your-secret-token changeme"
)
IDENTIFIERS = 4096  # identifiers in the dictionary at most
IDENTIFIER_DOCS = 3  # a string in so many texts and surroundings away from sensitive words names something
SURROUND = 32  # characters on either side that tell places of a string apart
INSIDE, OUTSIDE, LEFT, RIGHT = range(4)  # what an occurrence is evidence of

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the fixed patterns, in order; ends are exclusive, places are code points."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def long_strings(text: str, base: list[Span]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Places of whole long strings with digits and letters outside the base spans: those at most REACH characters away
    from a sensitive word, and all others."""
    near: list[tuple[int, int]] = []
    far: list[tuple[int, int]] = []
    starts, ends = [s for _, s, _ in base], list(accumulate((e for _, _, e in base), max))
    words = SENSITIVE.finditer(text)
    word = next(words, None)
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while word and word.end() + REACH < start:
            word = next(words, None)  # too far behind for this string and all later ones
        before = bisect_left(starts, end)
        if SECRET_SHAPE.match(m.group()) and not (before and ends[before - 1] > start):
            (near if word and word.start() - REACH <= end else far).append((start, end))
    return near, far


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Places of long strings with digits and letters near a sensitive word and outside the base spans."""
    return long_strings(text, base)[0] if SENSITIVE.search(text) else []


class Novelty:
    """Marginal compressed bytes of strings beside their surroundings and a dictionary."""

    def __init__(self, dictionary: bytes):
        shared = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=12)
        self._compress = zstandard.ZstdCompressor(
            level=12, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def of(self, text: str, start: int, end: int) -> float:
        """Bytes per character that text[start:end] adds to the frame of what surrounds it."""
        before, after = text[max(0, start - 2 * REACH) : start], text[end : end + 2 * REACH]
        without = len(self._compress((before + after).encode("utf-8", "replace")))
        whole = len(self._compress((before + text[start:end] + after).encode("utf-8", "replace")))
        return (whole - without) / (end - start)


def all_spans(text: str, novelty: Novelty, known: Iterable[str] = ()) -> list[Span]:
    """Spans of the patterns, and of the candidates that are new to the dictionary and not among `known` identifiers."""
    base, known = base_spans(text), frozenset(known)
    extra = [
        ("novel", a, b)
        for a, b in candidates(text, base)
        if text[a:b] not in known and novelty.of(text, a, b) >= NOVELTY
    ]
    return sorted([*base, *extra], key=_order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def identifiers(docs: DataFrame) -> tuple[bytes, DataFrame]:
    """The dictionary, and (digest, known): the strings beside sensitive words that are identifiers, by text.

    Evidence that a string is an identifier comes only from texts that never show it beside a sensitive word: at least
    IDENTIFIER_DOCS of them, no fewer than those that do, and with as many different surroundings on its left and on its
    right, so near copies and shared passages count once. Counts are exact and over all documents. The dictionary has
    the commonest identifiers and only primes; that a string is no secret is looked up in the whole table.
    """

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: set[tuple[str, int, int]] = set()
            for text, digest in zip(batch["text"], batch["digest"]):
                if not text:
                    continue
                near, far = long_strings(text, base_spans(text))
                secretive = {text[a:b] for a, b in near}
                rows.update((s, INSIDE, digest) for s in secretive)
                for a, b in far:
                    if (s := text[a:b]) not in secretive:
                        rows.add((s, OUTSIDE, digest))
                        rows.add((s, LEFT, _hash(text[max(0, a - SURROUND) : a])))
                        rows.add((s, RIGHT, _hash(text[b : b + SURROUND])))
            yield pd.DataFrame(sorted(rows), columns=["string", "side", "value"])

    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
    evidence = settle(texts.mapInPandas(strings, "string string, side int, value bigint").distinct(), "strings")
    counts = evidence.groupBy("string").agg(*[F.count_if(F.col("side") == k).alias(f"n{k}") for k in range(4)])
    least = F.greatest(F.lit(IDENTIFIER_DOCS), f"n{INSIDE}")
    known = settle(
        counts.where((F.col(f"n{OUTSIDE}") >= least) & (F.least(f"n{LEFT}", f"n{RIGHT}") >= IDENTIFIER_DOCS))
        .select("string", F.col(f"n{OUTSIDE}").alias("texts")), "identifiers",
    )
    commonest = known.orderBy(F.desc("texts"), "string").limit(IDENTIFIERS)
    names = [r.string for r in commonest.toLocalIterator()]
    beside = (
        evidence.where(F.col("side") == INSIDE).join(known, "string")
        .groupBy(F.col("value").alias("digest")).agg(F.collect_set("string").alias("known"))
    )
    dictionary = " ".join([*names[::-1], CODE_WORDS]).encode("utf-8", "replace")
    return dictionary, settle(beside, "beside")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _with_known(docs: DataFrame) -> tuple[bytes, DataFrame, str]:
    """The dictionary, and `docs` with the identifiers beside sensitive words of each text, and the name of that column,
    which is none of theirs."""
    dictionary, beside = identifiers(docs)
    digest, known = unused("digest", docs.columns), unused("known", docs.columns)
    named = beside.select(F.col("digest").alias(digest), F.col("known").alias(known))
    with_digest = docs.withColumn(digest, F.xxhash64(F.col("text").cast("string")))
    return dictionary, with_digest.join(named, digest, "left").drop(digest), known


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel.

    Null texts count as empty (no span, the digest of nothing); repeated rows stay; other columns are ignored.
    """
    dictionary, docs, known_names = _with_known(docs.select("doc_id", "text"))
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(shared.value)
        for texts, known in batches:
            rows = []
            for text, names in zip(texts, known):
                spans = all_spans(text or "", novelty, () if names is None else names)
                kinds = [k for k, _, _ in spans]
                base = joined([s for s in spans if s[0] != "novel"])
                rows.append((
                    kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                    hashlib.sha256(base.encode()).hexdigest(), joined(spans), kinds.count("novel"),
                ))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return docs.select("doc_id", of(F.col("text").cast("string"), known_names).alias("_r")).select("doc_id", "_r.*")


def redacted_text(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every span replaced; of overlapping spans the union is."""
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with the secrets of `text` replaced by [SECRET]; columns as they were, whatever their names.

    Every row stays, repeated ones too; null texts stay null and empty ones empty. No documents give none.
    """
    names = docs.columns
    dictionary, docs, known_names = _with_known(docs)
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    @F.pandas_udf("string")
    def clean(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        novelty = Novelty(shared.value)
        for texts, known in batches:
            yield pd.Series(
                [t and redacted_text(t, all_spans(t, novelty, () if k is None else k)) for t, k in zip(texts, known)],
                dtype=object,
            )

    return docs.withColumn("text", clean(F.col("text").cast("string"), known_names)).select(*names)
