"""Near copies by Jaccard similarity of word shingles: SimHash and MinHash bands propose, exact similarity decides.

Texts of the same words are one node before anything is compared. Op 8's fingerprints (three words, two bits) propose
the nodes they link. For what these miss, each node emits BANDS keys of ROWS minima each; nodes of one key are compared
with the least of them, those that were not similar with the least of their rest, ROUNDS times. These rounds join large
groups of copies by as many pairs as they have nodes. Where nodes of one key are in several components after them, all
nodes of that key are compared with each other, in blocks, so that every similar pair that shares a key is linked,
directly or by way of others. Every link is verified on the whole shingle sets of both texts. Two texts of similarity 0.8
share a key with probability 1 - (1 - 0.8^5)^24, 0.99993.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.common import tokens_of
from curbside.llm.components import connected_components
from curbside.llm.simhash import fingerprint_links, majority, shingle_hashes
from curbside.session import discard, fresh_folder, settle, settle_at

SHINGLE = 5
SIMILARITY = 80  # percent
BANDS, ROWS = 24, 5
ROUNDS = 3  # of comparisons with one centre a key; the keys that are still of several components are compared whole
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20  # nodes of a block, and their shingles, about; two blocks are compared in a task
_CHUNK = 2048  # shingles whose permutations are held at once

_RNG = np.random.default_rng(8)
_FACTOR = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSET = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def band_keys(hashes: np.ndarray) -> list[int]:
    """Keys of the bands of a shingle set, as signed 64-bit numbers; none for no shingles."""
    if not len(hashes):
        return []
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), _CHUNK):
        moved = low[at : at + _CHUNK, None] * _FACTOR + _OFFSET
        np.minimum(least, moved.min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    digest = lambda i: hashlib.blake2b(bytes([i]) + rows[i].tobytes(), digest_size=8).digest()
    return [int.from_bytes(digest(i), "big", signed=True) for i in range(BANDS)]


def _sketches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch:
            content = hashlib.blake2b(b" ".join(tokens_of(text)), digest_size=16).digest()
            rows.append((content, majority(shingle_hashes(text, 3)), band_keys(shingle_hashes(text, SHINGLE))))
        yield pd.DataFrame(rows, columns=["content", "fp", "bands"])


def _shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [np.unique(shingle_hashes(t, SHINGLE)).view(np.int64) for t in batch["text"]]
        yield pd.DataFrame({"content": batch["content"], "shingles": sets})


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of `pairs(a, b)` whose texts, of `texts(content, text)`, reach the similarity."""
    spark = pairs.sparkSession
    ends = pairs.select(F.col("a").alias("content")).union(pairs.select("b")).distinct()
    folder = fresh_folder(spark, "shingles")
    sets = settle_at(
        texts.join(ends, "content", "left_semi").mapInPandas(_shingles, "content binary, shingles array<bigint>"), folder
    )
    both = pairs.join(sets.select(F.col("content").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("content").alias("a"), F.col("shingles").alias("sa")), "a"
    )
    shared = F.size(F.array_intersect("sa", "sb"))
    alike = both.where(100 * shared >= SIMILARITY * (F.size("sa") + F.size("sb") - shared)).select("a", "b")
    links = settle(alike, "links")
    discard(spark, folder)  # the links are stored, and the sets are the largest thing on disk
    return links


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that sets share, for all pairs of them."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times[token] > 1  # what is in one set only is shared by none
    places = np.cumsum(times > 1) - 1
    token, owner = places[token[several]], owner[several]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)  # whole numbers, exact to 2^24
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, _CHUNK):
        a, b = np.searchsorted(token, (low, low + _CHUNK))
        inside = np.zeros((len(sets), _CHUNK), dtype=np.float32)
        inside[owner[a:b], token[a:b] - low] = 1
        shared += inside @ inside.T
    return shared


def _block_links(nodes: pd.DataFrame) -> pd.DataFrame:
    """Links between similar nodes of different components, as many as connect what all such links would."""
    nodes = nodes.drop_duplicates("content")
    content, component = nodes["content"].tolist(), nodes["component"].tolist()
    found: list[tuple[bytes, bytes]] = []
    if len(set(component)) > 1:
        sets = [np.asarray(x, dtype=np.int64) for x in nodes["shingles"]]
        sizes, shared = np.array([len(x) for x in sets]), _overlaps(sets)
        label = np.unique(np.array([c.hex() for c in component]), return_inverse=True)[1]
        unseen = np.ones(len(sets), dtype=bool)
        for start in range(len(sets)):
            waiting = [start] if unseen[start] else []
            unseen[start] = False
            while waiting:
                i = waiting.pop()
                common = shared[i].astype(np.int64)
                alike = 100 * common >= SIMILARITY * (sizes[i] + sizes - common)
                reached = np.flatnonzero(alike & (label != label[i]) & unseen).tolist()
                unseen[reached] = False
                waiting += reached
                found += [(min(content[i], content[j]), max(content[i], content[j])) for j in reached]
    return pd.DataFrame(found, columns=["a", "b"])


def links_of_rest(keyed: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) that `links` lack between the components they give: nodes of one key of `keyed(content, band)`
    are all compared, where that key's nodes are of several components.

    Nodes of a key are dealt to blocks, and every two blocks are compared, so a task holds two blocks whatever a key's
    number of nodes.
    """
    spark = keyed.sparkSession
    found = connected_components(links).withColumnRenamed("node", "content")
    named = keyed.join(found, "content", "left").select("content", "band", F.coalesce("component", "content").alias("component"))
    spread = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    mixed = settle(named.join(spread.select("band"), "band"), "mixed")
    folder = fresh_folder(spark, "shingles")
    sets = settle_at(
        texts.join(mixed.select("content").distinct(), "content", "left_semi").mapInPandas(
            _shingles, "content binary, shingles array<bigint>"
        ),
        folder,
    )
    sizes = mixed.join(sets.select("content", F.size("shingles").alias("size")), "content")
    blocks = sizes.groupBy("band").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0))))
    dealt = mixed.join(blocks, "band").select("content", "component", "band", "blocks", block.alias("block"), other.alias("other"))
    # a block meets itself where it meets any other
    dealt = dealt.where("block <> other or blocks = 1").select(
        "content", "component", "band", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    )
    met = dealt.join(sets, "content").groupBy("band", "first", "second").applyInPandas(_block_links, "a binary, b binary")
    out = settle(met.distinct(), "links")
    discard(spark, folder)
    return out


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of `nodes(content, fp)` that op 8's fingerprints propose: the nodes of one fingerprint with the least
    of them, and the least ones of two linked fingerprints."""
    least = nodes.groupBy("fp").agg(F.min("content").alias("a"))
    same = nodes.join(least, "fp").where("content <> a").select("a", F.col("content").alias("b"))
    links = fingerprint_links(nodes.select("fp").distinct())
    ends = [least.select(F.col("fp").alias(side), F.col("a").alias(f"{side}_node")) for side in ("a", "b")]
    across = links.join(ends[0], "a").join(ends[1], "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    return same.union(across)


def similar_links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) among `nodes(content, fp, bands)`."""
    links = similar(settle(fingerprint_pairs(nodes), "proposed"), texts)
    rest, keyed = nodes.select("content", F.explode("bands").alias("band")), None
    for _ in range(ROUNDS):
        centres = rest.groupBy("band").agg(F.min("content").alias("a"), F.count("*").alias("n")).where("n > 1")
        near = settle(
            rest.join(centres, "band").where("content <> a").select("band", "a", F.col("content").alias("b")), "near"
        )
        if near.isEmpty():
            break
        if keyed is None:  # all nodes that share a key
            centres = near.select(F.col("a").alias("content"), "band").distinct()
            keyed = near.select(F.col("b").alias("content"), "band").union(centres)
        linked = similar(near.select("a", "b").distinct(), texts)
        links = links.union(linked)
        rest = settle(near.join(linked, ["a", "b"], "left_anti").select(F.col("b").alias("content"), "band"), "rest")
    if keyed is None:
        return links
    links = settle(links, "links")
    return links.union(links_of_rest(keyed, links, texts))


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component of similar texts: the least doc_id, any one of repeated rows, null ids
    last; columns as they were, whatever their names.

    Null texts and texts without words are one text; texts under five words are alike if they have the same words. No
    documents give none.
    """
    names = [F.col(f"row.{c}").alias(c) for c in docs.columns]
    sketch = F.pandas_udf(_sketches, "content binary, fp bigint, bands array<bigint>")
    stored = settle(
        docs.select(F.struct(*docs.columns).alias("row"), sketch(F.col("text").cast("string")).alias("s"))
        .select("row", "s.content", "s.fp", "s.bands", F.monotonically_increasing_id().alias("at")),
        "sketches",
    )
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("at"))
    nodes = settle(
        stored.groupBy("content").agg(F.min(order).alias("o"), F.min("fp").alias("fp"), F.min("bands").alias("bands")), "nodes"
    )
    texts = stored.join(nodes.select(F.col("o.at").alias("at")), "at", "left_semi").select(
        "content", F.col("row.text").cast("string").alias("text")
    )
    links = similar_links(nodes.select("content", "fp", "bands"), texts)
    found = connected_components(links).withColumnRenamed("node", "content")
    kept = (
        nodes.join(found, "content", "left").groupBy(F.coalesce("component", "content")).agg(F.min("o").alias("o"))
        .select(F.col("o.at").alias("at"))
    )
    return stored.join(kept, "at", "left_semi").select(*names)
