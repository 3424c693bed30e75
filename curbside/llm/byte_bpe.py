"""Byte-level BPE on padded numpy matrices.

Texts are cut by the tokenizer's pattern. Pieces not met before are sorted into buckets by length; a bucket is one
padded matrix of token ids. In every round each row merges its leftmost pair of least rank: ranks come from a hash
table of all mergeable pairs, the merged row is compacted by one column, and rows without a mergeable pair leave the
matrix. A pair's rank is kept beside it, so a merge looks up its two new neighbours only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces up to this many bytes go to matrices; each round costs a row's length, so longer ones are merged by a heap.
MATRIX_BYTES = 1024
#: Cells of one matrix, and pieces kept between batches: bounds on a worker's memory, without effect on results.
MATRIX_CELLS = 4_000_000
CACHED_PIECES = 200_000

_NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, _NONE, dtype=np.int32)
        self.probes = 0
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            # of those that want the same free slot, one gets it; the others go on
            free = self.keys[slot[rest]] == np.uint64(2**64 - 1)
            self.keys[slot[rest[free]]] = keys[rest[free]]
            won = self.keys[slot[rest]] == keys[rest]
            self.values[slot[rest[won]]] = merged[rest[won]]
            rest = rest[~won]
            slot[rest] = (slot[rest] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, _NONE where a pair does not merge or an id is negative (padding)."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero((at != keys) & (at != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (at != np.uint64(2**64 - 1))]
        out[(left < 0) | (right < 0)] = _NONE
        return out


class ByteBpe:
    """Encoder and decoder for a file of base64 tokens and ranks; the rank of a token is its id."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.split = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, merged = (np.array(c, dtype=np.int32) for c in zip(*pairs)) if pairs else [np.zeros(0, np.int32)] * 3
        self.pairs = PairTable(left, right, merged)
        self.cache: dict[str, bytes] = {}

    # -- encoding ---------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        pieces = [self.split(text) for text in texts]
        known = self.cache
        if len(known) > CACHED_PIECES:
            known.clear()
        new = list({p for found in pieces for p in found if p not in known})
        known.update(zip(new, self._encode_pieces([p.encode("utf-8") for p in new])))
        get = known.__getitem__
        return [b"".join(map(get, found)) for found in pieces]

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:  # a piece that is a token is never cut
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > MATRIX_BYTES:
                out[i] = np.array(self._merge_long(piece), dtype="<u4").tobytes()
            else:
                buckets.setdefault((len(piece) + 3) // 4 if len(piece) <= 32 else 100 + len(piece).bit_length(), []).append(i)
        for members in buckets.values():
            width = max(len(pieces[i]) for i in members)
            step = max(1, MATRIX_CELLS // width)
            for start in range(0, len(members), step):
                rows = members[start : start + step]
                self._merge_matrix(pieces, rows, width, out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        lengths = np.array([len(pieces[i]) for i in rows])
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), dtype=np.uint8).reshape(-1, width)
        ids = self.single[raw]
        ids[np.arange(width) >= lengths[:, None]] = -1
        ranks = np.full(ids.shape, _NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        owners = np.array(rows)
        while len(ids):
            at = ranks.argmin(axis=1)  # the first of equal ranks is the leftmost
            every = np.arange(len(ids))
            least = ranks[every, at]
            going = least != _NONE
            if not going.all():
                self._finish(ids[~going], owners[~going], out)
                ids, ranks, owners, at, least = ids[going], ranks[going], owners[going], at[going], least[going]
                every = every[: len(ids)]
            if not len(ids):
                return
            # drop the column after each row's merge
            columns = np.arange(ids.shape[1] - 1)
            source = columns + (columns > at[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            ids[every, at] = least
            last = ids.shape[1] - 1
            after = np.where(at < last, ids[every, np.minimum(at + 1, last)], -1)
            ranks[every, at] = self.pairs.find(ids[every, at], after)
            before = at > 0
            ranks[every[before], at[before] - 1] = self.pairs.find(ids[every[before], at[before] - 1], least[before])

    @staticmethod
    def _finish(ids: np.ndarray, owners: np.ndarray, out: list[bytes]) -> None:
        counts = (ids >= 0).sum(axis=1)
        flat, width = ids.astype("<u4").tobytes(), ids.shape[1] * 4
        for k, (owner, n) in enumerate(zip(owners.tolist(), counts.tolist())):
            out[owner] = flat[k * width : k * width + 4 * n]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges by a heap of (rank, place), for pieces too long for a matrix."""
        ids = self.single[np.frombuffer(piece, dtype=np.uint8)]
        n = len(ids)
        ids, following, previous = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        token = self.tokens
        get = self.ranks.get

        def offer(i: int) -> None:
            if i >= 0 and following[i] < n:
                rank = get(token[ids[i]] + token[ids[following[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[following[i]]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = following[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = rank, -1
            following[i] = following[j]
            if following[i] < n:
                previous[following[i]] = i
            offer(i)
            offer(previous[i])
        return [t for t in ids if t >= 0]

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """One encoder per file and Python worker."""
    return ByteBpe(path, pattern)


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoded(text: Column, path: str | None = None) -> Column:
    """Column of token ids (array<int>) of a text column; null and empty texts give an empty array."""
    path = path or default_path()

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for batch in batches:
            yield pd.Series([np.frombuffer(b, dtype="<i4") for b in bpe.encode([t or "" for t in batch])], dtype=object)

    return of(text)


def encoded_and_restored(text: Column, path: str | None = None) -> Column:
    """Column of (token_ids, restored): the ids, and whether they decode to the text's bytes again. Null texts are empty."""
    path = path or default_path()

    @F.pandas_udf("token_ids array<int>, restored boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            texts = [t or "" for t in batch]
            ids = bpe.encode(texts)
            yield pd.DataFrame({
                "token_ids": [np.frombuffer(b, dtype="<i4") for b in ids],
                "restored": [bpe.decode(b) == t.encode("utf-8", "replace") for t, b in zip(texts, ids)],
            })

    return of(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """Column of bytes (binary) that a column of token ids stands for; null stays null."""
    path = path or default_path()

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for batch in batches:
            yield pd.Series([None if x is None else bpe.decode(np.asarray(x, "<u4").tobytes()) for x in batch], dtype=object)

    return of(ids)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the ids decoded again).

    Null texts count as empty: no token, digests of nothing. Repeated rows stay; other columns are ignored.
    """
    path = path or default_path()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            ids = bpe.encode([t or "" for t in batch["text"]])
            yield pd.DataFrame({
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            })

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return digests(pd.DataFrame({"text": b}) for b in batches)

    return docs.select("doc_id", of(F.col("text")).alias("_r")).select("doc_id", "_r.*")
