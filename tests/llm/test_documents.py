"""Operators on documents against brute force, on small tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from curbside.llm import byte_bpe, compression, gru, lm, mixing, outliers, ppm, secrets, simhash
from curbside.session import settle
from tests.llm.conftest import crc, rows


def tokens(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def test_lm_learns_from_every_training_document(spark):
    """Each document has a word of its own; learning moves its input weights, if the document is learned from."""
    docs = spark.createDataFrame([(i, f"w{i} " * 400) for i in range(40)], "doc_id bigint, text string")
    learn_from = F.col("doc_id") < 30
    counts = settle(lm.word_counts(docs, ~learn_from), "words")
    v = lm.vocabulary(counts)
    moved = (lm.learned(docs, learn_from, v)["input"] != lm.initial(v)["input"]).any(axis=1)
    assert {w for w, m in zip(v.words, moved[: v.frequent]) if m} == {b"", *[f"w{i}".encode() for i in range(30)]}


def test_lm_counts_and_base(table):
    got = lm.log_likelihood(table).collect()
    assert len(got) == len(rows())
    counts = Counter()
    for doc_id, text, *_ in rows():
        if crc(doc_id, 10):
            counts.update([*tokens(text), b""])
    total, types = sum(counts.values()), len(counts)
    want = Counter()
    for doc_id, text, *_ in rows():
        words = [*tokens(text), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)
        held = crc(doc_id, 10) in (0, None)
        want[(doc_id, held, len(words), sum(counts[w] > 0 for w in words), total, round(base, 4))] += 1
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got)
    assert found == want
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_lm_without_rows(nothing):
    assert lm.log_likelihood(nothing).count() == 0


def test_lm_tail_words_are_joined(table, monkeypatch):
    """A table of few words sends the others through the shuffle, with the same result."""
    whole = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 4)) for r in lm.log_likelihood(table).collect()}
    monkeypatch.setattr(lm, "TABLE_WORDS", 40)
    cut = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 4)) for r in lm.log_likelihood(table).collect()}
    assert cut == whole


def test_gru_gradients_and_normalisation():
    sizes = gru.Sizes(2)
    p = gru.initial(sizes, np.ones(128), np.ones(32), 160.0)
    p = {k: v.astype(np.float64) + np.random.default_rng(1).normal(0, 0.1, v.shape) for k, v in p.items()}
    docs = [np.array([3, 70, 130, 0]), np.array([1, 0]), np.array([140, 5, 64, 127, 9, 0])]
    w = next(gru.windows(docs, 0, 2, 8))
    h = np.zeros((w.inputs.shape[1], gru.HIDDEN))

    def loss(q) -> float:
        states, _, _ = gru.forward(q, w, h)
        return -float(gru.log_probabilities(q, sizes, states[w.valid].astype(np.float64), w.targets[w.valid]).mean())

    g, _ = gru.gradients(p, sizes, w, h)
    for name, value in g.items():
        rows_, value = value if isinstance(value, tuple) else (None, value)
        place = tuple(n // 2 for n in value.shape)
        at = place if rows_ is None else (rows_[place[0]], *place[1:])
        moved = []
        for step in (1e-3, -1e-3):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += step
            moved.append(loss(q))
        assert abs((moved[0] - moved[1]) / 2e-3 - value[place]) < 2e-3 * max(1.0, abs(value[place])), name
    # class and word probabilities of one state add up to one
    state = np.random.default_rng(2).normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = [float(gru.log_probabilities(p, sizes, state, np.array([t]))[0]) for t in range(sizes.inputs)]
    assert abs(sum(map(math.exp, every)) - 1) < 1e-4


def test_gru_gradients_of_rows_are_sums_over_their_places():
    """One row occurs a hundred times, row 0 only where a lane has ended: rows are those in use, with all their places."""
    sizes = gru.Sizes(2)
    p = gru.initial(sizes, np.ones(128), np.ones(32), 160.0)
    docs = [np.array([5] * 100 + [1]), np.array([7, 140, 1]), np.array([9] * 6 + [1])]
    (w,) = gru.windows(docs, 1, 3, 128)
    g, _ = gru.gradients(p, sizes, w, np.zeros((3, gru.HIDDEN), dtype=np.float32))
    rows_, values = g["input"]
    assert rows_.tolist() == [1, 5, 7, 9, 140] and not w.valid.all()
    # a lane alone, its mean weighed by its share of the places
    want = {r: np.zeros(3 * gru.HIDDEN) for r in rows_.tolist()}
    for doc in docs:
        (alone,) = gru.windows([doc], 1, 1, 128)
        part, _ = gru.gradients(p, sizes, alone, np.zeros((1, gru.HIDDEN), dtype=np.float32))
        for r, value in zip(*part["input"]):
            want[int(r)] += value * len(doc) / w.valid.sum()
    assert np.allclose(values, [want[r] for r in rows_.tolist()], rtol=1e-3, atol=1e-7)


def test_gru_prepares_only_what_a_step_needs(monkeypatch):
    """Scoring prepares the inputs once for all windows, a step of training only the rows that occur in it."""
    prepared, plain = [], gru.input_table
    monkeypatch.setattr(gru, "input_table", lambda *a: prepared.append(plain(*a)) or prepared[-1])
    sizes = gru.Sizes(4)
    p = gru.initial(sizes, np.ones(256), np.ones(32), 288.0)
    docs = [np.array([3] * 300 + [1]), np.array([2, 1])]
    gru.score(p, sizes, docs, 1)
    assert [t.shape[1] for t in prepared] == [sizes.inputs]
    prepared.clear()
    gru.train(p, sizes, [docs], 1)
    assert len(prepared) > 1 and max(t.shape[1] for t in prepared) == 3


def test_lm_state_is_carried_across_windows(monkeypatch):
    sizes = gru.Sizes(1)
    p = gru.initial(sizes, np.ones(64), np.ones(32), 96.0)
    p["word"] += np.random.default_rng(0).normal(0, 0.5, p["word"].shape).astype(np.float32)
    docs = [np.random.default_rng(i).integers(0, 96, size=n) for i, n in enumerate((1, 200, 33, 64, 65))]
    whole = gru.score(p, sizes, docs, 0)
    monkeypatch.setattr(gru, "SCORE_STEPS", 7)
    monkeypatch.setattr(gru, "SCORE_LANES", 2)
    assert np.allclose(gru.score(p, sizes, docs, 0), whole, rtol=1e-4)


def test_quality_classifier(table, labels, no_labels, nothing):
    got = compression.quality(table, labels).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r.held_out == (crc(r.doc_id, 3) in (1, None)) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    spam = {340 + i for i in range(20)}
    held = [r for r in got if r.held_out and r.doc_id is not None and (r.doc_id in spam or r.doc_id < 240)]
    assert np.mean([(r.predicted == 0) == (r.doc_id in spam) for r in held]) > 0.9
    assert compression.quality(table, no_labels).count() == len(rows())
    assert compression.quality(nothing, labels).count() == 0
    assert set(compression.keep_good(table, labels).columns) == set(table.columns)


def test_byte_bpe_equals_tiktoken(table, nothing):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bpe = byte_bpe.load(path)
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    got = sorted(byte_bpe.round_trip(table).collect(), key=str)
    want = []
    for doc_id, text, *_ in rows():
        ids = np.array(whole.encode_ordinary(text or ""), dtype="<u4").tobytes()
        plain = hashlib.sha256((text or "").encode()).hexdigest()
        want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), plain))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert byte_bpe.round_trip(nothing).count() == 0


def test_byte_bpe_long_pieces():
    bpe = byte_bpe.load(byte_bpe.default_path())
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for text in ("ab" * 3000, "ñ" * 1025, "é" + "the" * 700, "=" * 5000, "\u0000퟿" * 20, "a", ""):
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == whole.encode_ordinary(text)
        assert bpe.decode(bpe.encode([text])[0]) == text.encode()


def statistics(text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, copies, counts = set(), 0, Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), copies, len(inside)


def test_outlier_statistics_and_verdicts(spark, table, nothing):
    got = outliers.judged(table).collect()
    want = Counter((r[0], *statistics(r[1])) for r in rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert outliers.judged(nothing).count() == 0


def test_outliers_against_brute_force(spark):
    """Distances equal those of the same concentration steps in numpy, and planted outliers are the rejected ones."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), size=rng.integers(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, size=rng.integers(80, 200))) for _ in range(300)]
    bad = [" ".join(w + "###" for w in rng.choice(words, size=100)) for _ in range(12)]
    df = spark.createDataFrame(
        [(i, t, "en", "a") for i, t in enumerate(texts + bad)], "doc_id int, text string, lang string, source string"
    )
    got = {r.doc_id: r for r in outliers.judged(df).collect()}
    assert {i for i, r in got.items() if not r.kept} == set(range(300, 312))
    stats = np.array([statistics(t) for t in texts + bad], dtype=float)
    n, chars, symbols, lines, repeated = stats.T
    x = np.column_stack([np.log(chars / n), np.sqrt(symbols / chars), np.sqrt(lines / n), np.sqrt(repeated / n)])
    d2 = np.array([got[i].d2 for i in range(312)])
    for _ in range(30):  # the reweighted estimate reproduces itself from its own inliers, up to the last steps
        inside = x[d2 <= outliers.chi_square_quantile(0.975, 4)]
        s = np.cov(inside.T, bias=True) * outliers._consistency(0.975) + np.diag(np.square(outliers.LEAST_SCALE))
        away = x - inside.mean(axis=0)
        d2 = (away @ np.linalg.inv(s) * away).sum(axis=1)
    kept = d2 <= outliers.chi_square_quantile(outliers.LEVEL, 4)
    assert [bool(k) for k in kept] == [got[i].kept for i in range(312)]


def test_ppm_accuracy_and_cases(table, nothing):
    got = ppm.identify(table).collect()
    assert len(got) == len(rows())
    text = {r[0]: r for r in rows() if r[0] is not None}
    right = [r.lang_pred == text[r.doc_id][2] for r in got if r.doc_id is not None and r.held_out and r.doc_id < 240]
    assert np.mean(right) > 0.95
    for r in got:
        assert r.held_out == (crc(r.doc_id, 4) in (2, None)) and 0 <= r.score <= 1
        if r.doc_id in (320, 321, 322, 323):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert ppm.identify(nothing).count() == 0
    assert {r.lang_pred for r in ppm.identify(table.where("doc_id is null")).collect()} == {"und"}


def test_ppm_code_lengths_against_brute_force():
    learned = {"a": [b"abracadabra", b"banana"], "b": [b"xyzzy plugh"]}
    coder = ppm.Coder(ppm.learn(learned))
    texts = [b"abra", b"zzz", b"", b"banana\xff plugh", b"a" * 50]
    got = coder.code_lengths(texts)
    for j, lang in enumerate(coder.model.languages):
        counts = defaultdict(Counter)
        for t in learned[lang]:
            padded = b"\0" * ppm.ORDER + t
            for i in range(ppm.ORDER, len(padded)):
                for k in range(ppm.ORDER + 1):
                    counts[padded[i - k : i]][padded[i]] += 1
        for i, text in enumerate(texts):
            bits, padded = 0.0, b"\0" * ppm.ORDER + text
            for at in range(ppm.ORDER, len(padded)):
                for k in range(ppm.ORDER, -1, -1):
                    seen = counts.get(padded[at - k : at])
                    if not seen:
                        continue
                    total = sum(seen.values()) + len(seen)
                    if padded[at] in seen:
                        bits -= math.log2(seen[padded[at]] / total)
                        break
                    bits -= math.log2(len(seen) / total)
                else:
                    bits += ppm.SYMBOL_BITS
            assert abs(bits - got[i, j]) < 1e-3, (lang, text)


def test_ppm_long_texts_in_pieces(monkeypatch):
    coder = ppm.Coder(ppm.learn({"a": [b"abracadabra"], "b": [b"hokus pokus"]}))
    texts = [b"abracadabra hokus " * 40, b"pokus"]
    whole = coder.code_lengths(texts)
    monkeypatch.setattr(ppm, "BLOCK", 13)
    assert np.allclose(coder.code_lengths(texts), whole, rtol=1e-5)


def test_secrets_base_and_novel(table, nothing):
    got = {r.doc_id: r for r in secrets.find_secrets(table).collect() if r.doc_id is not None}
    text = next(r[1] for r in rows() if r[0] == 400)
    r = got[400]
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 1, 0)
    spans = [("assign", *re.search(r'TOKEN = "[0-9A-F]+', text).span()), ("access", *re.search(r"AKIA\w+", text).span())]
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and joined in r.spans
    assert got[320].spans == "" and got[320].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.find_secrets(nothing).count() == 0
    cleaned = {r.doc_id: r.text for r in secrets.redact(table).collect()}
    assert "9233A8" not in cleaned[400] and "AKIA0" not in cleaned[400] and "é" in cleaned[400]
    assert cleaned[320] is None and cleaned[0] == rows()[0][1]


def test_secrets_novelty():
    novelty = secrets.Novelty(secrets.CODE_WORDS.encode())
    random_key = "bearer Zk3v9QpL0xWm7TbY2cRf8HsJ4uNd6GaE1iKo5"
    assert [k for k, *_ in secrets.all_spans(random_key, novelty)] == ["novel"]
    assert secrets.all_spans("secret your_api_key_here_0123456789abcdef0", novelty) == []
    assert secrets.all_spans("secret zzzzzzzzzzzzzzzz1zzzzzzzzzzzzzzzzzzzz", novelty) == []
    assert secrets.all_spans("nothing near Zk3v9QpL0xWm7TbY2cRf8HsJ4uNd6GaE1iKo5", novelty) == []


def test_mix(table, labels, no_labels, nothing):
    for marks in (labels, no_labels):
        got = mixing.mix(table, marks).collect()
        assert len(got) == len(rows())
        sizes = Counter((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows())
        assert Counter((r.doc_id, r["size"]) for r in got) == sizes
        assert all(r.taken <= 2 * r["size"] for r in got)
        by = defaultdict(list)
        for r in got:
            by[r.source_size, r.target].append(r)
        assert abs(sum(t for _, t in by) - 1.5 * sum(s for s, _ in by)) < 1e-6
        for (size, target), found in by.items():
            assert target <= 2 * size and abs(sum(r.taken for r in found) - target) <= max(r["size"] for r in found)
        again = mixing.mix(table.repartition(3), marks).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(nothing, labels).count() == 0
    copies = mixing.mixed(table, labels)
    assert copies.columns == table.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in copies.select("text").collect())
    assert words == sum(r.taken for r in mixing.mix(table, labels).collect())


def test_mix_targets(spark):
    """Sharing by weight and resharing the excess, step by step."""
    sizes = {"a": 100, "b": 1000, "c": 5000, "d": 10, "é": 700, None: 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    weight = dict(zip(sizes, (5, 2, 1, 5, 2, 1)))
    want, open_, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            want |= share
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    assert got == pytest.approx(want)


def simhash_of(text) -> int:
    words = tokens(text)
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints: dict) -> dict:
    keys = list(set(fingerprints))
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {k: root(k) for k in keys}


def test_simhash(table, nothing):
    got = simhash.near_duplicates(table).collect()
    prints = {i: simhash_of(r[1]) for i, r in enumerate(rows())}
    group = components(set(prints.values()))
    least = defaultdict(list)
    for i, r in enumerate(rows()):
        least[group[prints[i]]].append(r[0])
    want = Counter()
    for i, r in enumerate(rows()):
        ids = [d for d in least[group[prints[i]]] if d is not None]
        want[(r[0], f"{prints[i]:016x}", min(ids) if ids else None)] += 1
    assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns and kept.count() == len(least)


def test_ball_links_chains(spark):
    """Fingerprints in a chain of two-bit steps are one component; three bits apart is none."""
    base = 0x0123456789ABCDEF
    chain = [base, base ^ 0b11, base ^ 0b1111, base ^ (0b111 << 40), base ^ (1 << 63)]
    signed = [c - (1 << 64) if c >> 63 else c for c in chain]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    found = {r.fp: r.component for r in simhash.fingerprint_components(df).collect()}
    assert len({found[s] for s in (signed[0], signed[1], signed[2], signed[4])}) == 1
    assert found[signed[3]] == signed[3]
    with pytest.raises(ValueError):
        simhash.fingerprint_links(df, 3)


def test_secrets_at_the_end_of_a_window():
    """A string that begins in the last characters before the end of one word's reach is found whole."""
    novelty = secrets.Novelty(secrets.CODE_WORDS.encode())
    key = "Zk3v9QpL0xWm7TbY2cRf8HsJ4uNd6GaE1iKo5"
    filler = ("river walks under the green letter " * 4)
    for gap in range(60, 82):
        for tail in ("", " private"):
            text = "token " + filler[: gap - 2].ljust(gap - 2, "x") + " " + key + tail
            at = text.index(key)
            if at - len("token") <= secrets.REACH or tail:
                assert secrets.all_spans(text, novelty) == [("novel", at, at + len(key))], (gap, tail)
    assert secrets.all_spans("token " + "word " * 30 + key, novelty) == []


def test_secrets_in_near_copies_and_identifiers(spark, monkeypatch):
    """Near copies and shared passages hide no credential; identifiers are known however small the dictionary is."""
    key, name = "Zk3v9QpL0xWm7TbY2cRf8HsJ4uNd6GaE1iKo5", "Build2Qx7Target9VwMirror4Kz8Plugin3Jy"
    passage = f"the river walks private use {key} for it "
    copies = [(i, f"letter number {i} of the house. " * 3 + passage + "and the letter ends here " * (1 + i % 3)) for i in range(9)]
    # a credential that copies also show elsewhere, in one passage without a sensitive word
    bare = [(10 + i, f"text {i} " * 40 + "open the small green river house with " + key + " and then walk on under it") for i in range(9)]
    far = [(20 + i, f"page {i}{i} " * 40 + f"{i} see water{i} {name} under{i} the house " + f" {i}end" * 9) for i in range(9)]
    beside = [(30, f"with this auth we open {name} on the water")]
    df = spark.createDataFrame(copies + bare + far + beside, "doc_id int, text string").repartition(3)
    for size in (4096, 0):
        monkeypatch.setattr(secrets, "IDENTIFIERS", size)
        got = {r.doc_id: r.n_novel for r in secrets.find_secrets(df).collect()}
        assert got == {i: int(i < 9) for i, _ in copies + bare + far + beside}
        cleaned = {r.doc_id: r.text for r in secrets.redact(df).collect()}
        assert all(key not in cleaned[i] for i, _ in copies) and name in cleaned[30]
