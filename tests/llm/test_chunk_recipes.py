import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from brute import documents, prose
from zonecast.llm import chunk_recipes as cr


def brute(rows):
    groups = collections.defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub("[\\x20\\x09-\\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = collections.Counter()
    for norm, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for m in members:
            out[None if m[1] else m[2], keep, len(members), m[:3] == best[:3], hashlib.sha256(norm.encode()).hexdigest()] += 1
        ties = sum(m[:3] == best[:3] for m in members)  # rows repeated as a whole: one stays
        if ties > 1:
            key = (keep, keep, len(members), True, hashlib.sha256(norm.encode()).hexdigest())
            out[key] -= ties - 1
            out[(*key[:3], False, key[4])] += ties - 1
    return +out


def found(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def rows(odd_rows):
    r = random.Random(5)
    long = "".join(r.choice("abc .,\n") for _ in range(50_000))
    return odd_rows + [(700, long), (701, long.replace(" ", "\n ")), (702, long[:25_000] + "x" + long[25_000:]),
                       (703, "a\u00a0b"), (704, "ab"), (705, "a\x1cb"), (706, " a\x0b\x0cb\r"), (707, "😀 😀"), (708, "😀😀"),
                       (709, "漢" * 9000), (710, "漢 " * 9000), (711, ""), (None, "a b"), (712, "q" * 200_000)]


def test_equals_brute_force(spark, rows):
    assert found(cr.exact_duplicates(documents(spark, rows))) == brute(rows)


def test_colliding_identifiers_are_found_and_widened(spark, rows):
    weak = lambda c, parts: F.array(*(F.pmod(F.xxhash64(F.lit(k), c), F.lit(50)) for k in range(parts)))
    docs = documents(spark, rows)
    assert cr.verified_parts(docs, "text", 1, weak) > 1
    assert found(cr.exact_duplicates(docs, parts=1, identify=weak)) == brute(rows)


def test_extra_columns_empty_tables_and_a_hot_group(spark, none):
    rows = [(i, "same  text" if i % 3 else prose(i, 20)) for i in range(3000)]
    docs = documents(spark, rows)
    for name in ("row", "recipe", "group_size", "keep_id", "norm", "chunk", "id", "n_chars2", "kept"):
        docs = docs.withColumn(name, F.lit(1))
    assert found(cr.exact_duplicates(docs)) == brute(rows)
    assert cr.exact_duplicates(none).count() == 0


def test_chunks_join_to_the_text_and_follow_the_content(spark):
    a = ". ".join(prose(k, 3 + k % 17) for k in range(2000)) + "."
    texts = [a, a[:60_000] + "inserted. " + a[60_000:], "", "x" * 10_000, "漢" * 5000]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r.c for r in docs.select("doc_id", cr.chunks(cr.normalised(F.col("text"))).alias("c")).collect()}
    for i, t in enumerate(texts):
        assert "".join(got[i]) == re.sub("[\\x20\\x09-\\x0D]", "", t)
        assert all(len(c) <= cr.MAX_CHARS for c in got[i])
    assert len(set(got[0]) & set(got[1])) > 0.95 * len(got[0])  # an insertion changes the chunks around it
    store = {r.chunk: r.n_uses for r in cr.chunk_store(docs).collect()}
    assert store == collections.Counter(c for cs in got.values() for c in cs)


def test_no_python_on_the_main_path(spark, none):
    plan = cr.exact_duplicates(none)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
