"""Scores and the pipeline against plain Python, fitted models taken as given."""

import collections
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

import brute
from brute import documents, prose
from zonecast.llm import knn_quality, pii, textblocks, toxicity_pu
from zonecast.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def block(text):
    return next(textblocks.blocks(pa.array([text])))[2:]


def plain_toxicity(model, text):
    """Sum of the weights of the words and beginnings that the text holds."""
    weight, held = dict(zip(model.keys.tolist(), model.weights.tolist())), set()
    for w in set(brute.words(text)):
        held |= set(textblocks.word_beginnings(*block(w), toxicity_pu.PREFIXES)[0].tolist())
    z = model.bias + math.fsum(weight[h] for h in held if h in weight)
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def plain_quality(model, text):
    """Cosine-weighted vote of the nearest labelled vectors, by loops."""
    x = knn_quality.term_frequencies(*block(text))[0] if text else np.zeros(knn_quality.BINS)
    at = np.flatnonzero(x).tolist()
    x = {k: float(x[k]) * float(model.idf[k]) for k in at}
    n = math.sqrt(math.fsum(v * v for v in x.values()))
    x = {k: v / n for k, v in x.items()} if n > 1e-12 else {}
    latent = [math.fsum(v * float(model.axes[k, d]) for k, v in x.items()) for d in range(model.axes.shape[1])]
    n = math.sqrt(math.fsum(v * v for v in latent))
    latent = [v / n if n > 1e-12 else 0.0 for v in latent]
    cosine = [math.fsum(a * float(b) for a, b in zip(latent, v)) for v in model.vectors]
    near = sorted(range(len(cosine)), key=lambda k: -cosine[k])[:knn_quality.NEIGHBOURS]
    weight = [min(1, max(0, cosine[k])) ** knn_quality.SHARPNESS for k in near]
    vote = math.fsum(w * float(model.labels[k]) for w, k in zip(weight, near))
    return min(1, max(0, (vote + 0.1 * model.prior) / (math.fsum(weight) + 0.1)))


@pytest.mark.parametrize("op, plain, every", [(toxicity_pu, plain_toxicity, 1), (knn_quality, plain_quality, 20)])
def test_scores_equal_plain_python(spark, op, plain, every):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = op.train(docs, labels)
    got = {r.doc_id: r.score for r in op.score(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(got) == set(texts)
    for i in sorted(texts)[::every]:
        assert got[i] == pytest.approx(plain(model, texts[i]), abs=1e-9), i


def test_a_sample_is_bounded_in_rows(spark):
    rows = [(1, f"row {k} badword") for k in range(3000)] + [(k, prose(k, 20)) for k in range(2, 60)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, int(i == 1 or i % 9 == 0)) for i in range(1, 60)], LABELS)
    ids = labels.select("doc_id")
    assert len(toxicity_pu._gather(docs, ids, 40)) == 40
    assert len(toxicity_pu._gather(docs, ids, 10_000)) == len(rows)
    model = knn_quality.train(docs, labels, max_labelled=50)
    assert len(model.labels) <= 50


def test_anonymise_column_with_clashing_names(spark, odd):
    docs = odd
    for c in ("__redrawn", "__h", "doc", "entity", "kind"):
        docs = docs.withColumn(c, docs.doc_id)
    out = pii.anonymise_column(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_pipeline_equals_plain_stages(spark):
    import base64

    import corpus_pipeline as C
    import public_tokenizers
    import tiktoken
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity_pu.train(docs, labels)
    left = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    items = [brute.shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = []
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), name)
        after.append(docs.collect())
    left = {i: t for i, t in left.items() if plain_toxicity(model, t) < toxicity_pu.THRESHOLD}
    assert {r.doc_id for r in after[0]} == set(left)
    ids = sorted(left)
    root = brute.near_duplicates_by_index([left[i] for i in ids])[1]
    left = {ids[r]: left[ids[r]] for r in set(root)}
    assert {r.doc_id for r in after[1]} == set(left)
    left = {i: t for i, t in left.items()
            if not any(s and 100 * len(s & brute.shingles(t)) >= 75 * len(s) for s in items)}
    assert {r.doc_id: r.text for r in after[2]} == left
    # Entities: one surrogate a value, none shared, none a real value; other text as it was.
    new = {r.doc_id: r.text for r in after[3]}
    surrogate, real = collections.defaultdict(set), set()
    for i, text in left.items():
        found = sorted(pii.spans(text) if text else ())
        real |= {(pii.entity(k), pii.canonical(k, text[a:b])) for a, b, k in found}
        at, shift = 0, new[i] or ""
        for a, b, kind in found:
            kept = text[at:a]
            assert shift.startswith(kept)
            shift, at = shift[len(kept):], b
            rest = text[b:b + 12] if b < len(text) else ""
            end = shift.find(rest) if rest else len(shift)
            surrogate[pii.entity(kind), pii.canonical(kind, text[a:b])].add(pii.canonical(kind, shift[:end]))
            shift = shift[end:]
        assert shift == (text or "")[at:]
    with_one = {k: v for k, v in surrogate.items() if len(v) == 1}
    assert len(with_one) >= 0.95 * len(surrogate) > 0  # (the cut by the text after it may be ambiguous)
    drawn = collections.Counter((k[0], next(iter(v))) for k, v in with_one.items())
    assert max(drawn.values()) == 1 and not set(drawn) & real
    with open(vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in after[4]:
        ids = np.array(want.encode_ordinary(new[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((new[r.doc_id] or "").encode()).hexdigest()
    assert {r.doc_id for r in after[4]} == set(left)
