"""Language identification by prediction by partial matching.

For each language, byte contexts of length 0 to ORDER with the symbols seen after them form a context tree. The cost of
a byte is found in the longest context that has been followed by it: -log2(count / (total + distinct)); each longer
context that is known but never had it costs an escape, -log2(distinct / (total + distinct)) (method C, without
exclusions). A byte never seen costs 8 bits below the empty context. Statistics are frozen after learning, so the cost
depends on the last ORDER + 1 bytes alone: the trees of all languages are flattened into hash tables from byte strings
to code lengths, one column per language, and whole batches of texts are looked up at once, longest strings first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.common import remainder

ORDER = 4
SYMBOL_BITS = 8.0  # of a byte that no context knows

# Bounds of the sample that a language is learned from; of longer texts none is read.
SAMPLE_ROWS = 400
MAX_CHARS = 20_000
SAMPLE_BYTES = 400_000

#: Bytes looked up at once: a bound on a worker's memory, without effect on results.
BLOCK = 1 << 20

_EMPTY = np.uint64(2**64 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Open-addressing index from distinct 64-bit keys to their places, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY)
        self.places = np.full(1 << bits, -1, dtype=np.int32)
        slot, rest = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(rest):
            free = self.keys[slot[rest]] == _EMPTY
            self.keys[slot[rest[free]]] = keys[rest[free]]
            won = self.keys[slot[rest]] == keys[rest]
            self.places[slot[rest[won]]] = rest[won]
            rest = rest[~won]
            slot[rest] = (slot[rest] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where unknown."""
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.places[slot], -1)
        open_ = np.flatnonzero((at != keys) & (at != _EMPTY))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.places[slot[open_[hit]]]
            open_ = open_[~hit & (at != _EMPTY)]
        return out


def _strings(padded: np.ndarray, length: int) -> np.ndarray:
    """The last `length` bytes up to each place after the first ORDER places, as numbers."""
    n = len(padded) - ORDER
    codes = np.zeros(n, dtype=np.uint64)
    for back in range(length - 1, -1, -1):
        codes = (codes << np.uint64(8)) | padded[ORDER - back : ORDER - back + n]
    return codes


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, ORDER zero bytes before each; and which places belong to a text."""
    raw = np.frombuffer(b"".join(b"\0" * ORDER + t for t in texts), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    inside = np.ones(len(raw), dtype=bool)
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
    for k in range(ORDER):
        inside[starts + k] = False
    return raw, inside


@dataclass(frozen=True)
class Model:
    """Per order: known byte strings and their code lengths, known contexts and their escape costs (one column per
    language)."""

    languages: tuple[str, ...]
    strings: tuple[np.ndarray, ...]
    lengths: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    escapes: tuple[np.ndarray, ...]


def learn(texts: dict[str, list[bytes]]) -> Model:
    """A model of texts by language. Languages without a byte of text are left out."""
    texts = {k: [t for t in v if t] for k, v in sorted(texts.items())}
    texts = {k: v for k, v in texts.items() if v}
    columns = []
    for found in texts.values():
        padded, inside = _padded(found)
        # code strings of each order, at places that belong to a text
        columns.append([
            np.unique(_strings(padded, k + 1)[inside[ORDER:]], return_counts=True) for k in range(ORDER + 1)
        ])
    strings, lengths, contexts, escapes = [], [], [], []
    for k in range(ORDER + 1):
        all_strings = np.unique(np.concatenate([c[k][0] for c in columns])) if columns else np.zeros(0, np.uint64)
        all_contexts, context_of = np.unique(all_strings >> np.uint64(8), return_inverse=True)
        cost = np.zeros((len(all_strings), len(columns)), dtype=np.float32)
        escape = np.zeros((len(all_contexts), len(columns)), dtype=np.float32)
        for j, column in enumerate(columns):
            known, counts = column[k]
            count = np.zeros(len(all_strings))
            count[np.searchsorted(all_strings, known)] = counts
            total = np.bincount(context_of, weights=count, minlength=len(all_contexts))
            distinct = np.bincount(context_of, weights=count > 0, minlength=len(all_contexts))
            seen = total > 0
            escape[seen, j] = -np.log2(distinct[seen] / (total[seen] + distinct[seen]))
            if k:
                shorter = np.searchsorted(strings[-1], all_strings & np.uint64((1 << 8 * k) - 1))
                below = lengths[-1][shorter, j]
            else:
                below = SYMBOL_BITS
            has = count > 0
            cost[:, j] = escape[context_of, j] + below
            cost[has, j] = -np.log2(count[has] / (total + distinct)[context_of[has]])
        strings.append(all_strings)
        lengths.append(cost)
        contexts.append(all_contexts)
        escapes.append(escape)
    return Model(tuple(texts), tuple(strings), tuple(lengths), tuple(contexts), tuple(escapes))


class Coder:
    """Code lengths of texts under all languages of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.strings = [HashIndex(s) for s in model.strings]
        self.contexts = [HashIndex(c) for c in model.contexts]
        self.lengths = [np.ascontiguousarray(c.T) for c in model.lengths]
        self.escapes = [np.ascontiguousarray(c.T) for c in model.escapes]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.model.languages)))
        block, size = [], 0
        for i, text in enumerate(texts):
            # long texts go in pieces, each with the bytes before it as context
            for start in range(0, len(text), BLOCK):
                piece = text[max(0, start - ORDER) : start + BLOCK]
                block.append((i, piece.rjust(len(piece) + ORDER - min(ORDER, start), b"\0")))
                size += len(piece)
                if size >= BLOCK:
                    self._add(out, block)
                    block, size = [], 0
        self._add(out, block)
        return out

    def _add(self, out: np.ndarray, block: list[tuple[int, bytes]]) -> None:
        if not block:
            return
        raw = np.frombuffer(b"".join(piece for _, piece in block), dtype=np.uint8).astype(np.uint64)
        sizes = np.array([len(piece) for _, piece in block])
        owner = np.repeat(np.array([i for i, _ in block]), sizes)
        inside = np.ones(len(raw), dtype=bool)
        starts = np.cumsum(sizes) - sizes
        for k in range(ORDER):
            inside[starts + k] = False
        places = np.flatnonzero(inside[ORDER:])
        owner = owner[places + ORDER]
        code = _strings(raw, ORDER + 1)[places]
        for k in range(ORDER, -1, -1):
            code &= np.uint64((1 << 8 * (k + 1)) - 1)
            at = self.strings[k].find(code)
            known = at >= 0
            self._sum(out, owner[known], self.lengths[k], at[known])
            code, owner = code[~known], owner[~known]
            if not len(code):
                return
            at = self.contexts[k].find(code >> np.uint64(8))
            known = at >= 0
            self._sum(out, owner[known], self.escapes[k], at[known])
        out += SYMBOL_BITS * np.bincount(owner, minlength=len(out))[:, None]

    @staticmethod
    def _sum(out: np.ndarray, owner: np.ndarray, table: np.ndarray, at: np.ndarray) -> None:
        for j, column in enumerate(table):
            out[:, j] += np.bincount(owner, weights=column[at], minlength=len(out))


def predict(coder: Coder, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, share of it in the posterior of equal priors) per text; ('und', 0) without a letter."""
    languages = coder.model.languages
    bits = coder.code_lengths([(t or "").encode("utf-8", "replace") for t in texts])
    out = []
    for text, row in zip(texts, bits):
        if not languages or text is None or not any(map(str.isalpha, text)):
            out.append(("und", 0.0))
            continue
        best = int(row.argmin())
        out.append((languages[best], float(1.0 / np.exp2(np.maximum(row[best] - row, -1000.0)).sum())))
    return out


def sample(docs: DataFrame, learn_from: Column) -> dict[str, list[bytes]]:
    """Texts to learn each language from: the first of a hash order, the same ones at every run."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn_from)
    usable = usable.where(F.length("text").between(1, MAX_CHARS))
    order = F.xxhash64("doc_id")
    # the lowest hashes of each language, some four times as many as are needed: no task ranks more, however many tasks
    # there are
    sizes = usable.groupBy("lang").agg(F.count("*").alias("_n")).where(F.col("_n") > 4 * SAMPLE_ROWS)
    wide = sizes.select("lang", (-(2.0**63) + 2.0**64 * 4 * SAMPLE_ROWS / F.col("_n")).alias("_most"))
    # one row per language, as the model in memory has anyway; a shuffled join would move all rows before it cuts them
    few = usable.select("lang", "doc_id").join(F.broadcast(wide), "lang", "left").where(
        F.col("_most").isNull() | (order.cast("double") <= F.col("_most"))
    )
    first = (
        few.select("lang", "doc_id", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id")).alias("_k"))
        .where(F.col("_k") <= SAMPLE_ROWS).select("lang", "doc_id").distinct()
    )
    rows = usable.select("lang", "doc_id", "text").join(F.broadcast(first), ["lang", "doc_id"]).dropDuplicates(["lang", "doc_id"])
    texts: dict[str, list[bytes]] = {}
    used: dict[str, int] = {}
    for row in rows.orderBy("lang", order, "doc_id").select("lang", "text").toLocalIterator():
        raw = row.text.encode("utf-8", "replace")
        if used.get(row.lang, 0) + len(raw) <= SAMPLE_BYTES:
            texts.setdefault(row.lang, []).append(raw)
            used[row.lang] = used.get(row.lang, 0) + len(raw)
    return texts


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of the id mod `modulus` is `held`), lang_pred, score.

    Languages of held-out documents are never read. A null id counts as held out. Null texts and texts without a letter
    are `und` with score 0, as are all where no language was learned; equal code lengths go to the first language by
    name. Repeated rows stay; other columns are ignored.
    """
    model = learn(sample(docs, remainder("doc_id", modulus) != held))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        for batch in batches:
            yield pd.DataFrame(predict(coder, list(batch)), columns=["lang_pred", "score"])

    held_out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(True))
    return docs.select("doc_id", held_out.alias("held_out"), of(F.col("text")).alias("_r")).select("doc_id", "held_out", "_r.*")
