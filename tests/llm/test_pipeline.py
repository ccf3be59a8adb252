"""The pipeline, stage by stage, against brute force on each stage's own input."""

import hashlib
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from sessionloom.llm import common, mixing, queries

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
def test_stages(request, spark, name):
    docs = request.getfixturevalue(name).select("doc_id", "text", "lang", "source", "n_chars")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    before = Counter(map(tuple, docs.collect()))

    named = common.written(stages["language ID"](spark, docs, ""))
    left = Counter(map(tuple, named.collect()))
    assert named.columns == columns
    learned = any(r[2] is not None for r in before)
    assert left == Counter({r: n for r, n in before.items() if learned and any(c.isalpha() for c in r[1] or "")})

    single = common.written(stages["exact dedup"](spark, named, ""))
    best = {}
    for r in left:
        key = (r[1] or "").translate(LOWER)
        best[key] = max(best.get(key, (-1 << 63,)), r if r[0] is not None else (-1 << 62, *r[1:]), key=lambda x: x[0])
    assert {r[0] if r[0] != -1 << 62 else None for r in best.values()} == {r.doc_id for r in single.collect()}
    assert single.columns == columns

    apart = common.written(stages["SimHash near-dedup"](spark, single, ""))
    from test_near_stage import expected

    known = [(r.doc_id, r.text or "") for r in single.collect() if r.doc_id is not None]
    assert {r.doc_id for r in apart.collect() if r.doc_id is not None} == expected(known)
    assert apart.columns == columns

    mix = common.written(stages["mixing sources to target weights"](spark, apart, ""))
    assert mix.columns == columns
    assert Counter(r.doc_id for r in mix.collect()) == Counter(r.doc_id for r in mixing.mixed(apart).collect())

    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_file())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    wanted = Counter()
    for r in mix.collect():
        ids = library.encode(r.text or "")
        wanted[r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), tuple(ids)] += 1
    done = stages["SentencePiece encoding and decoding"](spark, mix, "").collect()
    assert Counter((*tuple(r)[:4], tuple(r.ids)) for r in done) == wanted


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
