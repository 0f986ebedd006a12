"""The corpus pipeline, each stage against a plain version over its own input."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
from conftest import SF_SMALL
from test_lines import plain as plain_lines
from test_simhash import plain_fingerprint, plain_roots
from tokenizers import Tokenizer

from odd_inputs import no_docs, odd_docs  # noqa: F401

from tradelanes.llm.queries import MIN_SITES, vocabulary_path
from tradelanes.session import stored


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF_SMALL), name.replace(" ", "_"))
        steps.append((docs.collect(), out.collect()))
        assert name == "bpe" or out.columns == columns
        docs = out
    (raw, good), (_, cleaned), (_, single), (_, clean), (_, tokens) = steps

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    assert np.mean([i in kept for i, q in labels.items() if q == 1]) >= 0.98
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) <= 0.2
    texts = {r.doc_id: r.text for r in raw}
    assert all(texts[r.doc_id] == r.text for r in good)

    right = plain_lines([(r.doc_id, r.text, r.lang, r.source) for r in good], MIN_SITES)
    assert {r.doc_id: r.text for r in cleaned} == right and all(r.n_chars == len(r.text) for r in cleaned)

    rows = sorted(cleaned, key=lambda r: r.doc_id)
    tops = set(plain_roots([plain_fingerprint(r.text) for r in rows], 2))
    assert sorted(single) == [r for k, r in enumerate(rows) if k in tops]

    words = lambda t: f" {' '.join(w.strip('.,').lower() for w in t.split())} "
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single if not any(i in words(r.text) for i in items))

    library = Tokenizer.from_file(vocabulary_path())
    got = {r.doc_id: r for r in tokens}
    assert len(got) == len(tokens) == len(clean)
    for r in clean:
        ids = library.encode(r.text, add_special_tokens=False).ids
        t = got[r.doc_id]
        assert (t.n_tokens, t.ids, t.decoded_sha256) == (len(ids), ids, hashlib.sha256(r.text.encode()).hexdigest())


def test_stages_take_odd_inputs(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, SF_SMALL)
            assert name == "bpe" or out.columns == docs.columns
            docs = stored(out, "odd")
        assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
