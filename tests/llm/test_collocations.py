"""Collocations and the FM-index against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from curbside.llm import collocations
from curbside.llm.fm_index import BidirectionalIndex, suffix_ranks
from tests.llm.conftest import SCHEMA, rows


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def expected(docs, least, top):
    """Rows by brute force for docs of (lang, text)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                gone.update(q for i in range(len(p) - k + 1) if 100 * a >= 80 * f[q := p[i : i + k]])
        found = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def prose(rng, n):
    words = "a b c d e f g h".split() + [f"w{i}" for i in range(60)]
    weights = [40, 30, 20, 15, 10, 8, 6, 5] + [1] * 60
    out = []
    while len(out) < n:
        out += rng.choices(words, weights, k=rng.randrange(1, 9)) + rng.choice([[], ["new", "york", "City"], ["In", "spite", "of", "it"]])
        out.append(rng.choice([".", ",", "\n", "\t", ""]))
    return " ".join(out)


@pytest.mark.parametrize("shard_tokens", [1 << 18, 700])
def test_against_counting(spark, monkeypatch, shard_tokens):
    monkeypatch.setattr(collocations, "SHARD_TOKENS", shard_tokens)
    rng = random.Random(7)
    data = [(rng.choice(["en", "de", None, "und"]), prose(rng, rng.randrange(0, 300))) for _ in range(120)]
    data += [("en", None), ("de", ""), (None, " ,.\n"), ("fr", "one word"), ("en", "same same same same same " * 40)]
    data += [data[3]] * 35 + [("x", "é É ß|q " * 50), ("y", "a b c d " * 3000)]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in data], "lang string, text string, phrase string, n int, id int")
    got = sorted(map(tuple, collocations.collocations(df.repartition(5), top=40).collect()))
    assert got == expected(data, collocations.LEAST, 40)


def test_awkward_documents(spark, table, nothing):
    assert collocations.collocations(nothing).collect() == []
    got = collocations.collocations(table).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == expected([(r[2], r[1]) for r in rows()], collocations.LEAST, collocations.TOP)
    assert "fingerprint" in SCHEMA


def test_index_extends_both_ways():
    rng = np.random.default_rng(9)
    for size in (1, 3, 40, 400):
        text = np.append(rng.integers(0, 5, size) * (rng.random(size) < 0.8), 0).astype(np.int32)
        want: Counter = Counter()
        piece: list[int] = []
        for w in text.tolist():
            if w:
                piece.append(w)
                continue
            for k in range(1, 5):
                want.update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
            piece = []
        index = BidirectionalIndex(text)
        level = index.single()
        for k in range(1, 5):
            assert dict(zip(map(tuple, level.words.tolist()), level.counts.tolist())) == {p: n for p, n in want.items() if len(p) == k}
            level = index.right(level) if k % 2 else index.left(level)


def test_suffixes_are_sorted():
    rng = np.random.default_rng(2)
    text = np.append(np.tile(rng.integers(1, 3, 50), 6), 0)
    text[[70, 71, 200]] = 0
    rank = suffix_ranks(text)
    ends = np.flatnonzero(text == 0)

    def suffix(i):
        stop = ends[np.searchsorted(ends, i)]
        return [*((1, w) for w in text[i:stop].tolist()), (0, int(stop))]

    assert sorted(range(len(text)), key=suffix) == np.argsort(rank).tolist()


def test_runs_of_common_pairs():
    text = np.array([1, 2, 3, 4, 0, 5, 6, 0, 1, 2, 3, 0])
    common = np.array([1, 1, 0, 0, 0, 1, 0, 0, 1, 0, 0, 0], dtype=bool)
    assert collocations.runs_of(text, common).tolist() == [1, 2, 3, 0]
    common[[2, 9]] = True
    assert collocations.runs_of(text, common).tolist() == [1, 2, 3, 4, 0, 1, 2, 3, 0]
