"""Log-likelihood of whole documents under a recurrent language model learned from the corpus.

Counts of all training tokens fix the vocabulary, its classes and every unigram share. The recurrent weights are then
learned from all training documents, each in one of the rounds: shards of them train side by side, and their parameters
are averaged after every round. All documents are scored, whole.

The commonest words go to the tasks as a table of bounded size. All others are joined by a shuffle; none of these can
be a hot key, being rarer than every word of the table. What they add to a document's score is a sum over their counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm import gru
from curbside.llm.common import remainder
from curbside.session import settle

END = b""  # the token after a text's last word; no word is empty

TABLE_WORDS = 200_000  # words in the table that goes to every task, at most
COUNTED_WORDS = 4_000_000  # words a counting task holds before it emits their counts
SMOOTHING = 0.1
SOFTMAX_WORDS = 0.37  # words with a place in a softmax, by the root of the number of training tokens

# Learning of the recurrent weights.
SHARD_TOKENS = 1_000_000  # of a shard, about, at least
SHARD_GROWTH = 300  # tokens of a shard, by the root of all: parameters grow with that root, those of all shards with the corpus
ROUNDS = 2  # every document is learned from in one of them
GROUP_TOKENS = 500_000  # of documents that are trained on together, about
SCORE_TOKENS = 1_500_000  # of documents that are scored together: lanes end together, long documents among many


# -- counts -------------------------------------------------------------------------------------


def word_counts(docs: DataFrame, held_out: Column) -> DataFrame:
    """(word, n_train, n_held): occurrences of every token in training and held-out texts of `docs(text)`."""

    names = ["word", "n_train", "n_held"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[pa.Array]] = [[], []]
        size, texts = [0, 0], [0, 0]

        def emitted(k: int) -> pa.RecordBatch:
            found = pc.value_counts(pa.concat_arrays(waiting[k]))
            n = pc.cast(found.field("counts"), pa.int64())
            zero = pa.array(np.zeros(len(n), dtype=np.int64))
            waiting[k], size[k] = [], 0
            words = found.field("values").cast(pa.large_binary()).cast(pa.binary())
            return pa.RecordBatch.from_arrays([words, *((zero, n) if k else (n, zero))], names)

        for batch in batches:
            is_held = batch.column(1)
            for k, chosen in enumerate((pc.invert(is_held), is_held)):
                given = batch.column(0).filter(chosen)
                words, _ = words_of(given)
                texts[k] += len(given)
                waiting[k].append(words)
                size[k] += len(words)
                if size[k] > COUNTED_WORDS:
                    yield emitted(k)
        for k in (0, 1):
            if size[k]:
                yield emitted(k)
        if sum(texts):
            ends = [pa.array([END], pa.binary()), *[pa.array([n], pa.int64()) for n in texts]]
            yield pa.RecordBatch.from_arrays(ends, names)

    counted = docs.select("text", held_out.alias("held")).mapInArrow(count, "word binary, n_train bigint, n_held bigint")
    return counted.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_held").alias("n_held"))


@dataclass(frozen=True)
class Vocabulary:
    """The table of common words with their training counts, the frequent ones first, and the open classes.

    `opened` maps the first two bytes of other words to classes; `open_shares` are the smoothed counts of these.
    """

    words: tuple[bytes, ...]
    counts: np.ndarray
    frequent: int
    opened: dict[bytes, int]
    open_shares: np.ndarray
    tokens: int
    types: int

    @property
    def sizes(self) -> gru.Sizes:
        width = max(1, math.ceil(math.sqrt(self.frequent)))
        return gru.Sizes(-(-self.frequent // width), width)

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTHING * (self.types + 1)

    def open_class(self, word: bytes) -> int:
        start = word[:2]
        found = self.opened.get(start)
        return sum(start) % gru.OPEN_CLASSES if found is None else found


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary of stored `counts`. What comes to the driver is bounded: the table, and sums by two bytes."""
    total = counts.agg(F.sum("n_train").alias("n"), F.count(F.when(F.col("n_train") > 0, 1)).alias("v")).first()
    # whole steps of frequency from the top, as many as fit: no task has to rank all words
    step = F.floor(F.log2(F.col("n_train") + F.col("n_held")) * 64).cast("int")
    sizes = {r.s: r.n for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}
    least, room = max(sizes, default=0) + 1, TABLE_WORDS
    while sizes.get(least - 1, 0) <= room and least > 0:
        least -= 1
        room -= sizes.get(least, 0)
    rows = [(bytes(r.word), int(r.n_train)) for r in counts.where(step >= least).collect()]
    rows.sort(key=lambda r: (-r[1], r[0]))
    softmax = int(SOFTMAX_WORDS * math.sqrt(total.n or 0)) + 1
    frequent = min(softmax, sum(n > 0 for _, n in rows))
    if END not in [w for w, _ in rows[:frequent]]:  # the end is always a frequent word, also without training texts
        ends = counts.where(F.octet_length("word") == 0).agg(F.sum("n_train")).first()[0]
        rows = [(END, int(ends or 0))] + [r for r in rows if r[0] != END]
        frequent = max(1, frequent)
    starts = counts.groupBy(F.substring("word", 1, 2).alias("s")).agg(
        F.sum("n_train").alias("n"), F.count(F.when(F.col("n_train") > 0, 1)).alias("v")
    )
    sums = {bytes(r.s): [int(r.n), int(r.v)] for r in starts.toLocalIterator()}
    for word, n in rows[:frequent]:
        if word[:2] in sums:
            sums[word[:2]][0] -= n
            sums[word[:2]][1] -= n > 0
    opened: dict[bytes, int] = {}
    mass = np.zeros(gru.OPEN_CLASSES)
    types = np.zeros(gru.OPEN_CLASSES)
    for start, (n, v) in sorted(sums.items(), key=lambda x: (-x[1][0], x[0])):
        k = opened[start] = int(mass.argmin())
        mass[k] += n
        types[k] += v
    return Vocabulary(
        tuple(w for w, _ in rows), np.array([n for _, n in rows], dtype=np.float64), frequent, opened,
        mass + SMOOTHING * (types + 1), int(total.n or 0), int(total.v or 0),
    )


def initial(v: Vocabulary) -> gru.Params:
    counts = np.zeros(v.sizes.words)
    counts[: v.frequent] = v.counts[: v.frequent] + SMOOTHING
    return gru.initial(v.sizes, counts, v.open_shares, counts.sum() + v.open_shares.sum())


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after the other, and their number per text. A word is what `tokens_of` says."""
    lowered = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    parts = pc.ascii_split_whitespace(lowered)
    numbers = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(parts)
    real = pc.not_equal(pc.binary_length(flat), 0)  # white space at a text's ends leaves empty words
    owner = np.repeat(np.arange(len(texts)), numbers)[real.to_numpy(zero_copy_only=False)]
    return flat.filter(real), np.bincount(owner, minlength=len(texts))


class Reader:
    """Texts to token ids of the model; what it needs of the base besides."""

    def __init__(self, v: Vocabulary):
        self.v = v
        first = v.sizes.words
        self.table = pa.array(v.words, pa.large_binary())
        self.ids = np.array([i if i < v.frequent else first + v.open_class(w) for i, w in enumerate(v.words)])
        self.end = v.words.index(END)
        self.first_open = first
        self.log_counts = np.log10(v.counts + SMOOTHING)
        self.log_open = np.log10(v.open_shares)

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """Per text: token ids, places in the table (-1 for other words), and the other words."""
        words, numbers = words_of(texts)
        words = words.cast(pa.large_binary())
        found = pc.fill_null(pc.index_in(words, value_set=self.table), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = np.flatnonzero(found < 0)
        rare = words.take(pa.array(other)).to_pylist()
        ids = self.ids[found]
        ids[other] = [self.first_open + self.v.open_class(w) for w in rare]
        stops = np.cumsum(numbers)
        rare_stops = np.searchsorted(other, stops)
        start = rare_start = 0
        for stop, rare_stop in zip(stops.tolist(), rare_stops.tolist()):
            end = [self.end]
            yield (
                np.concatenate([ids[start:stop], self.ids[end]]),
                np.concatenate([found[start:stop], end]),
                rare[rare_start:rare_stop],
            )
            start, rare_start = stop, rare_stop


# -- learning -----------------------------------------------------------------------------------


def round_of(doc_id: str = "doc_id") -> Column:
    """The round that learns from a document, by a hash of its id."""
    return F.pmod(F.xxhash64(F.lit("train"), doc_id), F.lit(ROUNDS)).cast("int")


def learned(docs: DataFrame, learn_from: Column, v: Vocabulary) -> gru.Params:
    """Parameters after ROUNDS of training on shards of `docs(doc_id, text)`, averaged after each. Every document of
    `learn_from` is learned from once, whole."""
    params = initial(v)
    shard = max(SHARD_TOKENS, SHARD_GROWTH * math.sqrt(v.tokens))
    shards = max(1, math.ceil(v.tokens / ROUNDS / shard))
    names = sorted(params)
    shapes = {n: params[n].shape for n in names}
    spark = docs.sparkSession
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((v, params))

        def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            vocabulary_, start = shared.value
            reader = Reader(vocabulary_)

            def groups() -> Iterator[list[np.ndarray]]:
                group, size = [], 0
                for batch in batches:
                    for ids, _, _ in reader.read(pa.array(batch["text"], pa.large_string())):
                        group.append(ids)
                        size += len(ids)
                        if size >= GROUP_TOKENS:
                            yield group
                            group, size = [], 0
                if group:
                    yield group

            p, tokens = gru.train(start, vocabulary_.sizes, groups(), reader.end)
            if tokens:
                flat = np.concatenate([p[n].ravel() for n in names]).astype("<f4").tobytes()
                yield pd.DataFrame({
                    "chunk": range(0, len(flat), _CHUNK), "tokens": float(tokens),
                    "part": [flat[i : i + _CHUNK] for i in range(0, len(flat), _CHUNK)],
                })

        given = docs.where(learn_from & (round_of() == turn)).select("text").repartition(shards)
        parts = given.mapInPandas(train, "chunk int, tokens double, part binary")
        parts = settle(parts.withColumn("slice", F.spark_partition_id() % 64), "weights")
        by_slice = parts.groupBy("chunk", "slice").applyInPandas(_mean, "chunk int, tokens double, part binary")
        whole = by_slice.groupBy("chunk").applyInPandas(_mean, "chunk int, tokens double, part binary")
        flat = b"".join(bytes(r.part) for r in whole.orderBy("chunk").toLocalIterator())
        if not flat:
            continue
        at, values = 0, np.frombuffer(flat, dtype="<f4")
        for n in names:
            size = int(np.prod(shapes[n]))
            params[n] = values[at : at + size].reshape(shapes[n]).copy()
            at += size
    return params


_CHUNK = 1 << 16


def _mean(parts: pd.DataFrame) -> pd.DataFrame:
    """Mean of parameter parts, weighted by the tokens they were trained on."""
    total = np.zeros(len(parts["part"].iloc[0]) // 4)
    for part, tokens in zip(parts["part"], parts["tokens"]):
        total += tokens * np.frombuffer(part, dtype="<f4")
    weight = parts["tokens"].sum()
    return pd.DataFrame({
        "chunk": [int(parts["chunk"].iloc[0])], "tokens": [weight], "part": [(total / weight).astype("<f4").tobytes()],
    })


# -- scoring ------------------------------------------------------------------------------------

_SCORED = (
    "doc_id {id}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "rare array<binary>, times array<int>"
)


def _scored(docs: DataFrame, v: Vocabulary, params: gru.Params) -> DataFrame:
    """Per document of `docs(doc_id, held_out, text)`: sums over the words of the table, and the other words."""
    shared = docs.sparkSession.sparkContext.broadcast((v, params))
    schema = _SCORED.format(id=docs.schema["doc_id"].dataType.simpleString())

    def batch_of(held: list, sums: list, rare: list[Counter]) -> pa.RecordBatch:
        ids = pa.concat_arrays([h.column(0) for h in held])
        held_out = pa.concat_arrays([h.column(1) for h in held])
        ends = pa.array(np.cumsum([0] + [len(r) for r in rare]), pa.int32())
        words = pa.ListArray.from_arrays(ends, pa.array([w for r in rare for w in r], pa.binary()))
        times = pa.ListArray.from_arrays(ends, pa.array([n for r in rare for n in r.values()], pa.int32()))
        n_tokens, n_known, base, score = (pa.array(list(c)) for c in zip(*sums))
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"]
        return pa.RecordBatch.from_arrays([ids, held_out, n_tokens, n_known, base, score, words, times], names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_, weights = shared.value
        reader = Reader(vocabulary_)
        per_token = math.log10(vocabulary_.base_total)

        def finished() -> pa.RecordBatch:
            model = gru.score(weights, vocabulary_.sizes, tokens, reader.end) / math.log(10)
            return batch_of(held, [(n, k, b, s + float(m)) for (n, k, b, s), m in zip(sums, model)], rare)

        tokens, sums, rare, held, size = [], [], [], [], 0
        for batch in batches:
            at = 0
            for i, (ids, places, others) in enumerate(reader.read(batch.column(2))):
                known = places[places >= 0]
                in_open = ids >= reader.first_open
                base = float(reader.log_counts[known].sum()) - per_token * len(ids)
                inside = float(reader.log_counts[known[reader.ids[known] >= reader.first_open]].sum())
                inside -= float(reader.log_open[ids[in_open] - reader.first_open].sum())
                tokens.append(ids)
                sums.append((len(ids), int((vocabulary_.counts[known] > 0).sum()), base, inside))
                rare.append(Counter(others))
                size += len(ids)
                if size >= SCORE_TOKENS:
                    held.append(batch.slice(at, i + 1 - at))
                    at = i + 1
                    yield finished()
                    tokens, sums, rare, held, size = [], [], [], [], 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if tokens:
            yield finished()

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, schema)


def log_likelihood(docs: DataFrame, modulus: int = 10) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` says that crc32 of the id mod `modulus` is 0; such documents, and those with a null id, are scored but
    not learned from. Null texts count as empty: one token, the end. Without training texts every word is unseen and the
    model is uniform over its classes. Repeated rows stay; other columns are ignored.
    """
    held = F.coalesce(remainder("doc_id", modulus) == 0, F.lit(True))
    counts = settle(word_counts(docs, held), "words")
    v = vocabulary(counts)
    params = learned(docs, ~held, v)
    partial = settle(
        _scored(docs.select("doc_id", held.alias("held_out"), "text"), v, params).withColumn("at", F.monotonically_increasing_id()),
        "scores",
    )
    rare = partial.select("at", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("at", "r.rare", "r.times")
    c = F.coalesce(F.col("n_train"), F.lit(0))
    added = (
        rare.join(counts.select(F.col("word").alias("rare"), "n_train"), "rare", "left")
        .groupBy("at").agg(
            F.sum(F.col("times") * F.log10(c + SMOOTHING)).alias("_sum"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_known"),
        )
    )
    joined = partial.drop("rare", "times").join(added, "at", "left")
    more = F.coalesce(F.col("_sum"), F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("_known"), F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
