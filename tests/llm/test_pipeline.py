"""Each stage of the pipeline against brute force, on its own input; then all of it."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import mixing, toxicity
from tidemark.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage got and returned, by name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    rows = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        got = docs.collect()
        out[name] = rows, got
        rows, docs = got, spark.createDataFrame(got, docs.schema)
    return out


def test_toxicity_stage(spark, stages):
    rows, got = stages["toxicity"]
    w, b = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r for r in rows if float(w[toxicity.features(r.text)].sum(dtype=np.float64)) + b < 0]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and 0 < len(got) < len(rows)


def test_line_stage(stages):
    rows, got = stages["line_dedup"]
    texts = sorted({(r.doc_id, r.text) for r in rows})
    recurring = brute.recurring_lines([t for _, t in texts])
    left = {r.doc_id: r.text for r in got}
    assert sorted(left) == [i for i, _ in texts]
    kept = 0
    for at, (doc_id, text) in enumerate(texts):
        lines, gone = text.split("\n"), set(recurring[at])
        fixed = Counter(x for i, x in enumerate(lines) if i not in gone)
        now = Counter(left[doc_id].split("\n")) if left[doc_id] or fixed else Counter()
        assert not fixed - now, doc_id  # no other line has gone
        assert not now - Counter(lines), doc_id
        kept += (now - fixed).total()
    assert kept <= len({t for x in recurring.values() for ts in x.values() for t in ts})  # a template stays in its first place at most


def test_join_stage(stages):
    rows, got = stages["ngram_join"]
    top, _ = brute.near_classes([r.text for r in rows])
    first = {}
    for r, t in zip(rows, top, strict=True):
        first[t] = min(first.get(t, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in got) == sorted(first.values())


def test_mixing_stage(spark, stages):
    rows, got = stages["mixing"]
    size = lambda r: len(brute.WORDS.findall(r.text or ""))
    sizes, taken, copies = Counter(), Counter(), Counter(tuple(r) for r in got)
    for r in rows:
        sizes[r.source] += size(r)
    for r in got:
        taken[r.source] += size(r)
    assert set(copies) <= {tuple(r) for r in rows} and max(copies.values()) <= mixing.MOST
    for source, target in brute.capped_targets(sizes).items():
        assert abs(taken[source] - target) <= max(size(r) for r in rows if r.source == source)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    rows, got = stages["packing"]
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, n in Counter(r.doc_id for r in rows).items():
        ids = np.array([*tok.encode(next(r.text for r in rows if r.doc_id == doc_id), add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert sum(p.length for p in by_doc[doc_id]) == n * len(ids) // 4
        assert all(p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)]) for p in by_doc[doc_id])
    for parts in by_seq.values():
        parts.sort()
        assert all(a == b for (a, _), b in zip(parts, np.cumsum([0, *(n for _, n in parts)]), strict=False)) and sum(n for _, n in parts) <= 2048


def test_run(spark, stages):
    """run() is the stages one after another; packing alone depends on where rows lie."""
    got = corpus_pipeline.run(spark, SF)
    narrow = lambda rows: Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert narrow(got.collect()) == narrow(stages["packing"][1])
