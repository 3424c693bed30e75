"""Collocations: phrases of two to four words that are common for how common their parts are.

Texts become shards of word ids, each of one language. Words that are rare over all shards end pieces, as no candidate
can have them. Each shard then counts its phrases with a bidirectional FM-index, and counts are summed across shards.
A phrase is common only if its pairs are, so pairs are summed first; shards learn which of theirs are common by a join,
and count longer phrases inside runs of such pairs only. What shards exchange are rows of (phrase, count); a word or
phrase that is in every shard is one row of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.fm_index import BidirectionalIndex
from curbside.session import discard, fresh_folder, settle, settle_at

PIECE_END = "[.,;:!?\\x0A-\\x0D]"
LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a candidate; how shards name phrases depends on it
NESTED = (4, 5)  # a candidate goes if a longer one around it has 4/5 of its occurrences
TOP = 2000  # of each language
UNKNOWN = "und"
SHARD_TOKENS = 1 << 18  # words of a shard, about; its index takes some 150 bytes a word
_PLACES = 32  # bits of a place inside a shard


# -- shards -------------------------------------------------------------------------------------


class _Pending:
    """Words of one language that wait to become a shard: strings, and whether a piece ends after each."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.ends: list[np.ndarray] = []
        self.size = 0

    def add(self, words: pa.Array, ends: np.ndarray) -> None:
        self.words.append(words)
        self.ends.append(ends)
        self.size += len(words)

    def cut(self) -> tuple[pa.Array, np.ndarray]:
        """The first SHARD_TOKENS words, to the end of their last piece, or all; a longer piece stays whole."""
        words, ends = pa.concat_arrays(self.words), np.concatenate(self.ends)
        stops = np.flatnonzero(ends) + 1
        at = int(stops[max(0, np.searchsorted(stops, SHARD_TOKENS, side="right") - 1)])
        self.words, self.ends, self.size = [words[at:]], [ends[at:]], len(words) - at
        return words[:at], ends[:at]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of texts, the text each is from, and whether a piece ends after it."""
    lowered = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    pieces = pc.split_pattern_regex(lowered, PIECE_END)
    words = pc.ascii_split_whitespace(pc.list_flatten(pieces))
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    piece = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(words)
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    piece = piece[real]
    ends = np.concatenate([piece[1:] != piece[:-1], [True]])[: len(piece)]
    return flat.filter(pa.array(real)), text[piece], ends


_SHARD = "task int, number int, lang string, n bigint, words array<string>, times array<int>, text binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, _Pending] = {}
    task, number = TaskContext.get().partitionId(), 0

    def shard(lang: str) -> pa.RecordBatch:
        nonlocal number
        words, ends = waiting[lang].cut()
        coded = words.dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        text = np.insert(ids, np.flatnonzero(ends) + 1, 0).astype("<i4")
        names = coded.dictionary.cast(pa.string())
        times = np.bincount(ids, minlength=len(names) + 1)[1:].astype(np.int32)
        columns = [pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([lang]), pa.array([len(ids)])]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), v) for v in (names, pa.array(times))]
        number += 1
        return pa.RecordBatch.from_arrays([*columns, pa.array([text.tobytes()])], [p.split()[0] for p in _SHARD.split(", ")])

    for batch in batches:
        words, text, ends = words_of(batch.column(1))
        langs = batch.column(0).dictionary_encode()
        of_word = langs.indices.to_numpy(zero_copy_only=False)[text]
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            here = of_word == k
            if here.any():
                waiting.setdefault(lang, _Pending()).add(words.filter(pa.array(here)), ends[here])
                while waiting[lang].size >= SHARD_TOKENS:
                    yield shard(lang)
        while sum(p.size for p in waiting.values()) > 3 * SHARD_TOKENS:  # many languages: the largest goes as it is
            yield shard(max(waiting, key=lambda name: waiting[name].size))
    for lang in waiting:
        while waiting[lang].size:
            yield shard(lang)


def common_words(shards: DataFrame) -> DataFrame:
    """(id, lang, word, f) of words with LEAST occurrences."""
    entries = shards.select("lang", F.explode(F.arrays_zip("words", "times")).alias("e"))
    counts = entries.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.times").alias("f"))
    return counts.where(F.col("f") >= LEAST).select(F.monotonically_increasing_id().alias("id"), "lang", "word", "f")


def _known(entries: DataFrame) -> DataFrame:
    """(shard, at, ids) from rows (shard, at, id): the places a shard is to know, with their ids."""
    sorted_ = entries.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("e"))
    return sorted_.select("shard", F.col("e.at").alias("at"), F.col("e.id").alias("ids"))


def _relabelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards over common words only: ids 1, 2, ... stand for `ids`, other words end pieces."""
    for batch in batches:
        out = []
        for text, at in zip(batch.column(2), batch.column(3)):
            text, at = np.frombuffer(text.as_buffer(), dtype="<i4"), at.values.to_numpy(zero_copy_only=False)
            table = np.zeros(int(text.max(initial=0)) + 1, dtype=np.int32)
            table[at + 1] = np.arange(1, len(at) + 1)
            out.append(squeezed(table[text]).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["shard", "ids", "text"])


def squeezed(text: np.ndarray) -> np.ndarray:
    """`text` without empty pieces, as 32-bit words."""
    keep = text != 0
    keep[1:] |= text[:-1] != 0
    return text[keep].astype("<i4")


# -- phrases of shards --------------------------------------------------------------------------


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of common words of each shard with their counts; the place is their number in the order of words."""
    for batch in batches:
        for shard, ids, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            text, ids = np.frombuffer(text.as_buffer(), dtype="<i4"), ids.values.to_numpy(zero_copy_only=False)
            if not len(text):
                continue
            index = BidirectionalIndex(text)
            found = index.right(index.single())
            place = (np.int64(shard) << _PLACES) + np.arange(len(found.counts))
            words = ids[found.words - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[:, 0]), pa.array(words[:, 1]), pa.array(place), pa.array(found.counts.astype(np.int32))],
                ["first", "second", "place", "n"],
            )


def runs_of(text: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The parts of `text` of three words and more in which all pairs are common. `common[i]`: that of words i, i + 1."""
    before = np.concatenate([[False], common[:-1]])
    after = np.concatenate([common[1:], [False]])
    before2 = np.concatenate([[False], before[:-1]])
    long = (common & (after | before)) | (before & before2)  # in two neighbouring pairs, or at an end of such
    out = np.where(long, text, 0)
    stop = long & ~common  # the last word of a run
    return squeezed(np.insert(out, np.flatnonzero(stop) + 1, 0))


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of three and four words, named by their first and last pair, from runs of common pairs."""
    names = ["first", "last", "length", "n"]
    for batch in batches:
        for text, at, ids in zip(batch.column(0), batch.column(1), batch.column(2)):
            text = np.frombuffer(text.as_buffer(), dtype="<i4").astype(np.int64)
            at, ids = at.values.to_numpy(zero_copy_only=False), ids.values.to_numpy(zero_copy_only=False)
            size = int(text.max(initial=0)) + 1
            pair = text * size
            pair[:-1] += text[1:]
            inner = (text > 0) & np.concatenate([text[1:] > 0, [False]])
            pairs = np.unique(pair[inner])[at]  # in the order in which they were numbered
            place = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            text = runs_of(text, inner & (pairs[place] == pair))
            if not len(text):
                continue
            index = BidirectionalIndex(text)
            three = index.right(index.right(index.single()))
            for phrases in (three, index.left(three)):
                w = phrases.words
                columns = [ids[np.searchsorted(pairs, w[:, k] * size + w[:, k + 1])] for k in (0, -2 % w.shape[1])]
                lengths = np.full(len(w), w.shape[1], dtype=np.int32)
                columns += [lengths, phrases.counts.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def common_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all words and phrases of up to LONGEST words with LEAST occurrences, and (lang, n), the
    number of all words, for `docs(lang, text)`."""
    spark = docs.sparkSession
    given = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.make_valid_utf8(F.col("text").cast("string")).alias("text"),
    )
    folder = fresh_folder(spark, "shards")
    shards = settle_at(given.mapInArrow(_shards, _SHARD), folder)
    most = (shards.agg(F.max("number")).first()[0] or 0) + 1
    shards = shards.withColumn("shard", F.col("task").cast("long") * most + F.col("number"))
    totals = settle(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = settle(common_words(shards), "words")
    entries = shards.select("shard", "lang", F.posexplode("words").alias("at", "word"))
    known = _known(entries.join(words.select("lang", "word", "id"), ["lang", "word"]))
    text = shards.select("shard", "text").join(known, "shard").select("shard", "ids", "text", "at")
    text = settle(text.mapInArrow(_relabelled, "shard bigint, ids array<bigint>, text binary"), "text")
    discard(spark, folder)

    same = Window.partitionBy("first", "second")
    pairs = text.mapInArrow(_pairs, "first bigint, second bigint, place bigint, n int")
    pairs = pairs.withColumns({"f": F.sum("n").over(same), "id": F.min("place").over(same)})
    pairs = settle(pairs.where(F.col("f") >= LEAST).drop("n"), "pairs")
    shard, at = F.shiftright("place", _PLACES), F.col("place").bitwiseAND(F.lit((1 << _PLACES) - 1)).cast("int")
    known = _known(pairs.select(shard.alias("shard"), at.alias("at"), "id"))
    longer = (
        text.select("shard", "text").join(known, "shard").select("text", "at", "ids")
        .mapInArrow(_longer, "first bigint, last bigint, length int, n int")
        .groupBy("first", "last", "length").agg(F.sum("n").alias("f")).where(F.col("f") >= LEAST)
    )

    def word(name: str) -> DataFrame:
        return words.select(F.col("id").alias(name), F.col("lang").alias(f"{name}_lang"), F.col("word").alias(f"{name}_word"))

    named = settle(
        pairs.where(F.col("place") == F.col("id")).join(word("first"), "first").join(word("second"), "second")
        .select("id", F.col("first_lang").alias("lang"), F.col("first_word").alias("w1"), F.col("second_word").alias("w2"), "f"),
        "named",
    )
    start = named.select(F.col("id").alias("first"), "lang", "w1", "w2")
    stop = named.select(F.col("id").alias("last"), F.col("w1").alias("w3"), F.col("w2").alias("w4"))
    four = F.when(F.col("length") == 4, F.concat_ws(" ", "w1", "w2", "w3", "w4")).otherwise(F.concat_ws(" ", "w1", "w2", "w4"))
    counts = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    counts = counts.unionAll(named.select("lang", F.concat_ws(" ", "w1", "w2"), F.lit(2), "f"))
    counts = counts.unionAll(longer.join(start, "first").join(stop, "last").select("lang", four, "length", "f"))
    return settle(counts, "counts"), totals


# -- candidates ---------------------------------------------------------------------------------


def _exact(column: str | Column) -> Column:
    return F.col(column).cast("decimal(38,0)") if isinstance(column, str) else column.cast("decimal(38,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more in `counts`, by their lowest-scoring cut."""
    part = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"),
        F.array_join(F.slice("ws", 1, k), " ").alias("left"),
        F.array_join(F.slice("ws", k + 1, F.col("size") - k), " ").alias("right"),
    ))
    cuts = (
        counts.where(F.col("size") > 1).withColumn("ws", F.split("phrase", " "))
        .select("lang", "phrase", F.col("f").alias("a"), F.explode(part).alias("c"))
        .select("lang", "phrase", "a", "c.k", "c.left", "c.right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(38,0)) * a) DIV (l + r)"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("c"))
    return lowest.select("lang", "phrase", "c.*")


def nested(counts: DataFrame) -> DataFrame:
    """(lang, phrase) of the phrases that a longer one has inside with nearly all of their occurrences."""
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice("ws", i, k), " ")
    )))
    longer = counts.where(F.col("size") > 2).withColumn("ws", F.split("phrase", " "))
    most = longer.select("lang", F.explode(inside).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    share, whole = NESTED
    found = counts.join(most, ["lang", "phrase"]).where(_exact("most") * whole >= _exact("f") * share)
    return found.select("lang", "phrase")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language of `docs(lang, text)`: lang, rank, phrase, a, l, r, n, score.

    A null language is `und`; null and empty texts have no words; repeated rows count again; other columns are ignored.
    No candidate, or no documents, gives no rows. A language without candidates has none.
    """
    counts, totals = common_phrases(docs)
    kept = scored(counts).join(nested(counts), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
