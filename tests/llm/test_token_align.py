import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import documents
from zonecast.llm import token_align as ta
from zonecast.llm.queries import ALIGNED, QUERIES, vocabulary_path

PATHS = tuple(map(vocabulary_path, ALIGNED))


def random_ends(r, n, share):
    last = 3 * n
    return sorted({*r.sample(range(1, last), int(share * last)), last})


@pytest.mark.parametrize("share", [0.02, 0.3, 0.9])
def test_groups_end_where_both_sequences_end(share):
    r = random.Random(share)
    for n in [1, 2, 3, 10, 50, 400]:
        for _ in range(20):
            a = random_ends(r, n, share)
            for b in (random_ends(r, n, share), a, [x for x in a[:-1] if r.random() > 0.05] + a[-1:]):
                i, j = ta.align(a, b)
                both = np.intersect1d(a, b)
                assert [a[k - 1] for k in i] == both.tolist() == [b[k - 1] for k in j]


def test_cancelling_irregular_groups_in_a_long_run():
    a = list(range(1, 1000))
    b = [x for x in a if x not in (300, 400)]
    a2 = [x for x in a if x not in (350, 450)]  # the shift goes away and comes back
    i, _ = ta.align(a2, b)
    assert [a2[k - 1] for k in i] == np.intersect1d(a2, b).tolist()


def test_both_encoders_of_the_byte_level_vocabulary_agree(rows):
    from tokenizers import Tokenizer
    aligner = ta.Aligner(*(open(p, "rb").read() for p in PATHS))
    plain = Tokenizer.from_file(PATHS[0])
    plain.encode_special_tokens = True
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" " + "".join(every[k:k + 1000]) for k in range(0, len(every), 1000)]
    texts += [" " + (t or "") for _, t in rows] + [" " * 50_000 + "a", "a" * 20_000, "\n" * 300_000]
    assert aligner.ranked
    for t in texts:
        assert aligner.a_ids([t])[0] == plain.encode(t, add_special_tokens=False).ids


def brute(rows):
    """Every report row, by joining both tokenisations in plain Python."""
    import re

    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte = ta.byte_level_alphabet()
    seen, links = [], collections.Counter()
    for _, text in rows:
        text = text or ""
        ai, bi = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        at = [bytes(byte[c] for c in a.id_to_token(i)) for i in ai]
        pieces = [b.id_to_piece(i) for i in bi]
        bt = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or not b"".join(at) == b"".join(bt) == (" " + text).encode():
            seen.append(([], [], [], []))
            continue
        ae, be = np.cumsum([len(x) for x in at]).tolist(), np.cumsum([len(x) for x in bt]).tolist()
        own = [(ai[i], bi[be.index(e)]) for i, e in enumerate(ae) if e in set(be)]
        shown, i, j = [], 0, 0
        for e in sorted(set(ae) & set(be)):
            i2, j2 = ae.index(e) + 1, be.index(e) + 1
            shown.append(",".join(map(str, ai[i:i2])) + "|" + ",".join(map(str, bi[j:j2])))
            i, j = i2, j2
        seen.append((ai, bi, shown, own))
        links.update(own)
    top = collections.Counter()
    for (_, y), n in links.items():
        top[y] = max(top[y], n)
    out = collections.Counter()
    for (ident, _), (ai, bi, shown, own) in zip(rows, seen):
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest() if ai else ""
        out[ident, len(ai), len(bi), len(shown), len(own), sum(links[p] == top[p[1]] for p in own),
            sum(links[p] for p in own), digest] += 1
    return out, links


@pytest.fixture(scope="module")
def rows(odd_rows):
    r = random.Random(2)
    alphabet = list("  \n\tabcdefgé中文😀ß12,.!?́\x00\x1c▁<>|")
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 60))) for _ in range(400)]
    texts += ["<|endoftext|> <s> </s> <0x41> <unk>", "a▁b", " ", "\n", "x" * 3000, "the cat. " * 300, "﻿", "é"]
    short = [(i, t if t is None or len(t) < 9000 else t[:9000]) for i, t in odd_rows]
    return short + list(enumerate(texts, 1000))


@pytest.mark.parametrize("hot", [1, 50, ta.HOT])
def test_report_equals_brute_force(spark, rows, hot):
    docs = documents(spark, rows)
    for name in ("row", "pair", "pairs", "times", "n", "best", "b_id"):
        docs = docs.withColumn(name, F.lit(1))
    want, _ = brute(rows)
    assert collections.Counter(tuple(r) for r in ta.alignment_report(docs, *PATHS, hot=hot).collect()) == want


def test_pairs_and_spans(spark, rows):
    want, links = brute(rows)
    docs = documents(spark, rows)
    got = ta.linked_pairs(ta.digests(docs, *PATHS), ta.vocabulary_size(PATHS[1])).collect()
    assert {(r.a_id, r.b_id): r.n for r in got} == links
    top = {b: max(n for (_, y), n in links.items() if y == b) for _, b in links}
    assert all(r.best == (r.n == top[r.b_id]) for r in got)
    sizes = collections.Counter((r.doc_id, len(r.a_ids), len(r.b_ids), len(r.a_ends)) for r in ta.spans(docs, *PATHS).collect())
    assert sizes == sum((collections.Counter({k[:4]: n}) for k, n in want.items()), collections.Counter())


def test_no_documents(none):
    assert ta.alignment_report(none, *PATHS).count() == 0


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute([(i, t) for i, t in data if len(t or "") < 20_000])
    got = collections.Counter(tuple(r) for r in ta.alignment_report(
        spark.createDataFrame([x for x in data if len(x[1] or "") < 20_000], "doc_id long, text string"), *PATHS).collect())
    assert got == want
    assert QUERIES["op11_token_alignment"](spark, sf).count() == len(data)
