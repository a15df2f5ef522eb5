"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

import corpus_pipeline as P
from podelta.llm import piece_codec, quality_rules
from podelta.llm.common import stage
from podelta.llm.queries import model_path
from tests.llm.test_operators import SF, brute_components, brute_copies, brute_counts, brute_fingerprint, brute_private


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    at, out = docs, []
    for name, function in P.STAGES:
        at = stage(function(spark, at, SF), name.replace(" ", "-"))
        out.append(at)
    assert all(x.columns == docs.columns for x in out[:-1])
    texts = [{r.doc_id: r.text for r in x.collect()} for x in out[:-1]]

    def clean(t):
        n, _, _, _, repeat = brute_counts(t)
        return n >= 10 and 100 * repeat <= 20 * n and quality_rules.judge(t.encode(), quality_rules.compressor())[3] is None

    assert texts[0] == {d: t for d, t in given.items() if clean(t)}
    root = brute_components({d: brute_fingerprint(t) for d, t in texts[0].items()})
    assert texts[1] == {d: texts[0][d] for d in set(root.values())}
    assert set(texts[2]) == set(texts[1]) and not any(brute_private(t) for t in texts[2].values())
    assert all(texts[2][d] == t for d, t in texts[1].items() if not any(c in t for c in "@+0123456789"))
    assert all(r.n_chars == len(r.text) for r in out[2].collect())
    source = {r.doc_id: r.source for r in out[2].collect()}
    sizes = {s: list(source.values()).count(s) for s in set(source.values())}
    scale = len(source) / sum(n ** 0.5 for n in sizes.values())
    want = {d: brute_copies(d, s, scale * sizes[s] ** 0.5 / sizes[s]) for d, s in source.items()}
    mixed = [r.doc_id for r in out[3].collect()]
    assert {d: mixed.count(d) for d in source} == want
    codec = piece_codec.Codec(piece_codec.load(model_path()))
    rows = out[4].collect()
    assert sorted(r.doc_id for r in rows) == sorted(mixed)
    assert all(r.piece_ids == codec.encode(texts[2][r.doc_id]).tolist() and r.n_pieces == len(r.piece_ids) for r in rows)
    assert sorted(r.doc_id for r in P.run(spark, SF).collect()) == sorted(mixed)


def test_empty_documents(spark):
    at = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in P.STAGES:
        at = stage(function(spark, at, SF), "empty")
    assert at.count() == 0
