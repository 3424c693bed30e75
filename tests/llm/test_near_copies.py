"""The near-dedup stage against all pairs of five-word shingle sets; fingerprints alone link nothing."""

from __future__ import annotations

import random

import corpus_pipeline
from curbside.llm import near_copies
from curbside.llm.components import connected_components
from tests.llm.conftest import prose


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_stage_keeps_one_of_similar_texts(spark):
    rng = random.Random(5)
    texts = []
    for i in range(40):
        words = prose(rng, "en", 300).split()
        texts.append(" ".join(words))
        for changes in (1, 3, 5, 9):  # similarities from 0.97 down to about 0.7
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    kept = corpus_pipeline.simhash_near_dedup(spark, df, "")
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {root(i) for i in range(len(texts))}


def test_texts_of_one_template_stay(spark):
    """No two are similar; some have fingerprints at most two bits apart, and all share MinHash keys with others."""
    rng = random.Random(6)
    frame = prose(rng, "en", 400).split()
    texts = []
    for _ in range(120):
        words = list(frame)
        for i in range(0, 400, 25):
            words[i] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    assert all(10 * len(a & b) < 8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    assert corpus_pipeline.simhash_near_dedup(spark, df, "").count() == 120


def of_one_key(spark, texts: list[str]) -> set[frozenset[int]]:
    """Components of more than one text, where all share one key and no fingerprints are near each other."""
    rng = random.Random(8)
    name = lambda i: i.to_bytes(2, "big")
    nodes = [(bytearray(name(i)), rng.getrandbits(63), [1]) for i in range(len(texts))]
    stored = [(bytearray(name(i)), text) for i, text in enumerate(texts)]
    links = near_copies.similar_links(
        spark.createDataFrame(nodes, "content binary, fp bigint, bands array<bigint>"),
        spark.createDataFrame(stored, "content binary, text string"),
    )
    groups: dict[bytes, set[int]] = {}
    for r in connected_components(links).collect():
        groups.setdefault(bytes(r.component), set()).add(int.from_bytes(r.node, "big"))
    return {frozenset(g) for g in groups.values()}


def test_pairs_behind_many_unlike_centres_are_linked(spark, monkeypatch):
    """Texts 8 and 9 are similar; eight others of their key, unlike all, come before them."""
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(9)]
    texts.append(texts[8] + " end")
    assert of_one_key(spark, texts) == {frozenset({8, 9})}
    monkeypatch.setattr(near_copies, "BLOCK", 2)
    assert of_one_key(spark, texts) == {frozenset({8, 9})}


def test_members_of_two_centres_are_linked(spark):
    """A chain: each text is similar to the next only. The centres are its ends, 0 and 1."""
    words = [f"w{i}" for i in range(130)]
    chain = [" ".join(words[i : i + 100]) for i in (0, 30, 10, 20)]
    assert of_one_key(spark, chain) == {frozenset(range(4))}
