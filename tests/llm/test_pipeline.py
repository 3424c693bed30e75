"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from curbside.llm import byte_bpe, compression, secrets
from tests.llm.conftest import SCHEMA, rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def similar_groups(texts) -> list[int]:
    """The least place that five-word similarity of 0.8 connects each text with."""
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in words]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


CLASHING = ("_digest", "_known", "_quality", "quality", "digest", "known", "row", "at", "size", "key", "S", "content")


def test_stages_keep_columns_of_any_name(spark, table, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = table.select(*COLUMNS, *[F.lit(i).alias(name) for i, name in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        row = kept.first()
        assert [row[c] for c in CLASHING] == list(range(len(CLASHING))), name


def test_run(spark, labels, tmp_path):
    folder = str(tmp_path)
    data = [(*r, len(r[1] or "")) for r in rows()]
    spark.createDataFrame(data, ", ".join(SCHEMA.split(", ")[:5])).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        kept.append(docs.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == COLUMNS
    good, single, clean, mixed, tokens = kept

    verdicts = compression.quality(spark.read.parquet(f"{folder}/documents.parquet"), labels).collect()
    wanted = Counter(r.doc_id for r in verdicts if r.predicted)
    assert Counter(r.doc_id for r in good) == wanted and len(good) < len(data)
    group = similar_groups([r.text for r in good])
    members = defaultdict(list)
    for r, g in zip(good, group):
        members[g].append(r)
    first = [min(m, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for m in members.values()]
    assert Counter(map(tuple, single)) == Counter(map(tuple, first))

    assert len(clean) == len(single)
    found = {r.doc_id: r for r in clean}
    for r in single:
        base = secrets.base_spans(r.text or "")
        for kind, a, b in base:
            assert r.text[a:b] not in found[r.doc_id].text
        if not secrets.SENSITIVE.search(r.text or "") and not base:
            assert found[r.doc_id].text == r.text

    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for source in {r.source for r in clean}:
        whole = sum(size(r.text) for r in clean if r.source == source)
        taken = sum(size(r.text) for r in mixed if r.source == source)
        assert taken <= 2 * whole
    longest = max(size(r.text) for r in clean)
    total = sum(size(r.text) for r in clean)
    assert abs(sum(size(r.text) for r in mixed) - 1.5 * total) <= longest * 3
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in clean}

    bpe = byte_bpe.load(byte_bpe.default_path())
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    want = Counter((r.doc_id, r.lang, r.source, tuple(whole.encode_ordinary(r.text or ""))) for r in mixed)
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.token_ids)) for r in tokens) == want
    assert all(r.n_tokens == len(r.token_ids) and r.restored for r in tokens)

    run = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in run) == Counter((r.doc_id, tuple(r.token_ids)) for r in tokens)


def test_stages_over_no_documents(spark, labels, nothing, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = nothing.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
        docs = docs if docs.columns == COLUMNS else nothing.select(*COLUMNS)
