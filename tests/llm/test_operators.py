import collections
import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from brute import documents, edited, prose
from zonecast.llm import (backoff, bbpe, cover_tree, cross_blocks, decontam, ext_hash, graph, knn_quality, lsh_forest,
                          para_dedup, pii, textblocks, toxicity_pu)
from zonecast.llm.queries import vocabulary_path

LABELS = "doc_id long, quality int, toxic int"


def clashing(df):
    """The same rows with extra columns named like results and internals."""
    for c in ("score", "kept", "component_id", "key", "id", "block", "values", "part", "h", "n"):
        df = df.withColumn(c, F.lit("x"))
    return df


# -- shared hashing ---------------------------------------------------------

def test_shingle_sets_equal_brute_force(odd_rows):
    texts = [t for _, t in odd_rows]
    got = list(textblocks.text_sets(pa.array(texts)))
    want = [brute.shingles(t) for t in texts]
    assert [len(x) for x in got] == [len(x) for x in want]
    number = {}
    for t, s in zip(want, got):
        for x in t:
            number.setdefault(x, len(number))
    assert len(np.unique(np.concatenate(got))) == len(number)
    for i in range(0, len(texts), 7):
        for j in range(0, len(texts), 5):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_hashes_do_not_depend_on_blocks(odd_rows):
    column = pa.array([t for _, t in odd_rows])
    small = [textblocks.words(d, o)[0] for _, _, d, o in textblocks.blocks(column, 50)]
    large = [textblocks.words(d, o)[0] for _, _, d, o in textblocks.blocks(column)]
    assert (np.concatenate(small) == np.concatenate(large)).all()


@pytest.mark.parametrize("one_task", [0, graph.ONE_TASK])
def test_components_of_chains_stars_and_nothing(spark, monkeypatch, one_task):
    monkeypatch.setattr(graph, "ONE_TASK", one_task)
    pairs = [(i, i + 1) for i in range(50)] + [(1000, 1000 + k) for k in range(1, 40)] + [(7, 3), (2000, 2000)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{1000 + k: 1000 for k in range(1, 40)}}
    assert graph.components(df.filter("a < 0")).count() == 0


# -- op 1 -------------------------------------------------------------------

def test_near_duplicates_equal_brute_force(odd, odd_rows):
    got = sorted((tuple(r) for r in lsh_forest.near_duplicates(clashing(odd)).collect() if r.doc_id is not None))
    named = [(i, t) for i, t in odd_rows if i is not None]
    sizes, root = brute.near_duplicates([t for _, t in named])
    want = sorted((i, n, named[r][0], i == named[r][0]) for (i, _), n, r in zip(named, sizes, root))
    assert got == want


def test_near_duplicates_of_null_ids_and_nothing(odd, none):
    rows = lsh_forest.near_duplicates(odd).filter("doc_id IS NULL").collect()
    assert [(r.component_id, r.kept) for r in rows] == [(None, True)] * 2
    assert lsh_forest.near_duplicates(none).count() == 0


def test_dense_group_and_common_passage_components(spark):
    base, shared = prose(5, 200), prose(6, 120)
    rows = [(k, edited(base, k, 0.01)) for k in range(400)]                      # one dense group
    rows += [(1000 + k, shared + " " + prose(900 + k, 100)) for k in range(400)]  # not similar enough
    rows += [(2000 + k, edited(rows[400 + k][1], k, 0.005)) for k in range(20)]
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(documents(spark, rows)).collect()}
    sizes, root = brute.near_duplicates([t for _, t in rows])
    assert got == {i: rows[r][0] for (i, _), r in zip(rows, root)}


def families():
    """Ten structures of two families of 200 near copies; within each, a
    number of members are true links between the families."""
    import random
    rows = []
    for s in range(10):
        r = random.Random(s)
        base = [f"s{s}w{k}" for k in range(300)]
        other = list(base)
        for at in r.sample(range(300), 8):
            other[at] = f"s{s}o{at}"
        for f, words in enumerate((base, other)):
            for k in range(200):
                w = list(words)
                for at in r.sample(range(300), 2):
                    w[at] = f"e{r.randrange(10**9)}"
                rows.append((10_000 * s + 1000 * f + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("partitions, block", [(7, lsh_forest.BLOCK), (211, 16)])
def test_dense_families_with_few_bridges(spark, partitions, block):
    rows = families()
    sizes, root = brute.near_duplicates_by_index([t for _, t in rows])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(
            documents(spark, rows).repartition(partitions), block=block).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: rows[r][0] for (i, _), r in zip(rows, root)}


def test_representatives_with_clashing_column_names(odd, odd_rows):
    docs = odd
    for c in ("__text", "__gone", "doc", "print", "id", "kept", "component_id", "n_shingles", "label", "group"):
        docs = docs.withColumn(c, F.lit("x"))
    left = lsh_forest.keep_representatives(docs)
    assert left.columns == docs.columns
    want = collections.Counter(r.doc_id for r in lsh_forest.keep_representatives(odd).collect())
    assert collections.Counter(r.doc_id for r in left.collect()) == want


def test_representatives_keep_one_row_and_all_columns(odd):
    left = lsh_forest.keep_representatives(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(8) == 0 and ids.count(7) == 1 and ids.count(None) == 2 and {0, 1, 2} <= set(ids)


# -- op 2 -------------------------------------------------------------------

@pytest.mark.parametrize("limit", [200, 5000, 10**9])
def test_shards_fit_and_split_only_large_buckets(odd, odd_rows, limit):
    rows = ext_hash.shards(clashing(odd), limit=limit).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode())) for i, t in odd_rows)
    size, number = collections.Counter(), collections.Counter()
    for r in rows:
        size[r.depth, r.prefix, r.page] += r.n_bytes
        number[r.depth, r.prefix, r.page] += 1
        key = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:8], 16)
        assert key >> (32 - r.depth) == r.prefix
    assert all(b <= limit or number[s] == 1 for s, b in size.items())
    for r in rows:
        assert r.page or r.shard_bytes == size[r.depth, r.prefix, r.page]
        if r.depth and not r.page:  # its parent was too large
            parent = sum(x.n_bytes for x in rows if x.depth >= r.depth and
                         x.prefix >> (x.depth - r.depth + 1) == r.prefix >> 1)
            assert parent > limit


def test_copies_of_one_id_overflow_into_pages(spark, none):
    rows = [(1, "y" * 100)] * 50 + [(2, "z")]
    got = ext_hash.shards(documents(spark, rows), limit=450).collect()
    size = collections.Counter()
    for r in got:
        size[r.depth, r.prefix, r.page] += r.n_bytes
    assert len(got) == 51 and max(size.values()) <= 450
    assert ext_hash.shards(none).count() == 0


def test_written_shards_hold_every_row(spark, odd, odd_rows, tmp_root):
    ext_hash.write_shards(odd, f"{tmp_root}/shards", limit=3000)
    back = spark.read.parquet(f"{tmp_root}/shards")
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(map(str, odd_rows))


# -- op 3 -------------------------------------------------------------------

def test_passages_are_found_wherever_they_stand(spark):
    passage, near = prose(50, 60, 5000), prose(51, 60, 5000)
    rows = [(k, f"{prose(600 + k, 40 + k, 9000)} {passage} {prose(700 + k, 31, 9000)}") for k in range(30)]
    rows += [(100 + k, prose(800 + k, 200, 9000)) for k in range(30)]           # clean
    words = near.split(" ")
    rows += [(200, near), (201, " ".join([*words[:59], "other"]))]
    rows += [(300, prose(52, 45, 9000)), (301, prose(53, 45, 9000) + " " + prose(50, 18, 5000))]
    df = documents(spark, rows)
    found = para_dedup.repeats(clashing(df))
    got = {r.doc_id: r for r in para_dedup.by_document(found).collect()}
    assert set(got) == {*range(30), 200, 201}
    assert got[0].n_removed == 0 and all(got[k].n_removed == got[k].n_repeated > 0 for k in range(1, 30))
    text = {r.doc_id: r.text for r in para_dedup.remove(df).collect()}
    source = dict(rows)
    assert text[0] == source[0] and all(text[k] == source[k] for k in range(100, 130))
    for k in range(1, 30):
        assert source[k].startswith(text[k][:60]) and len(source[k]) - len(text[k]) > len(passage) // 3


def test_near_equal_paragraphs_join_one_cluster():
    words = prose(60, 24, 9000).split(" ")
    other = ["changed", *words[1:]]
    sets = []
    for w in (words, other):
        raw = " ".join(w).encode()
        s = textblocks.shingles(*[textblocks.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[k] for k in (0, 3)])[0]
        sets.append(s)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), *(pa.array([para_dedup.pack(s)]) for s in sets)],
                                       ["a", "b", "xs", "ys"])
    assert next(para_dedup.confirm([batch])).to_pylist() == [{"a": 1, "b": 2}]  # 19 of 21 shingles
    assert 1 - (1 - 0.75 ** para_dedup.ROWS) ** para_dedup.BANDS >= para_dedup.RECALL


def _calls(run):
    """(result, calls of functions made by this process) of ``run()``."""
    made = [0]

    def count(frame, event, arg):
        made[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        out = run()
    finally:
        sys.setprofile(None)
    return out, made[0]


def test_paragraphs_are_packed_and_confirmed_without_a_loop_over_rows():
    texts = [prose(90000 + k, 300, 9000) for k in range(60)]
    texts += [texts[0], None, "", "short"]
    marks, sets = [], {}
    for _, _, data, off in textblocks.blocks(pa.array(texts)):
        text, _, _, inside, at, _ = para_dedup.paragraphs(data, off)
        prints = para_dedup.fingerprint(inside, at).tolist()
        marks += zip(text.tolist(), prints)
        sets.update((m, {int(v) >> 24 for v in inside[p:q]}) for m, p, q in zip(prints, at[:-1], at[1:]))
    wanted = [[m for t, m in marks if t == k and m % 3] if k < 60 else [1] for k in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(wanted, pa.list_(pa.int64()))], ["text", "wanted"])
    got, calls = _calls(lambda: [x for b in (batch, batch.slice(3, 9)) for x in para_dedup.contents([b])])
    got = [(r["print"], {int.from_bytes(r["shingles"][k:k + 5], "big") for k in range(0, len(r["shingles"]), 5)},
            len(r["shingles"])) for b in got for r in b.to_pylist()]
    assert sorted(m for m, _, _ in got) == sorted(m for w in wanted[:60] + wanted[3:12] for m in set(w) & set(sets))
    assert all(x == sets[m] and n == 5 * len(x) for m, x, n in got)
    assert calls < 2 * len(got)  # 30 a paragraph before

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (40, 30), dtype=np.uint64)
    packed = [para_dedup.pack(np.append(base[k % 40, k // 40 % 9:], rng.integers(0, 2**63, k % 5, dtype=np.uint64)))
              for k in range(1500)]
    packed[7] = b""
    a, b = rng.integers(0, 1500, (2, 3000))
    b[::2] = (a[::2] + 40 * rng.integers(0, 30, 1500)) % 1480
    raw = [{p[k:k + 5] for k in range(0, len(p), 5)} for p in packed]
    want = [bool(raw[i] and raw[j]) and 100 * len(raw[i] & raw[j]) >= 75 * len(raw[i] | raw[j]) for i, j in zip(a, b)]
    rows = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([packed[i] for i in a]),
                                       pa.array([packed[i] for i in b])], ["a", "b", "xs", "ys"])
    got, calls = _calls(lambda: [(r["a"], r["b"]) for x in para_dedup.confirm([rows]) for r in x.to_pylist()])
    assert got == [(i, j) for i, j, w in zip(a.tolist(), b.tolist(), want) if w] and 100 < len(got) < 2900
    _, calls = _calls(lambda: list(para_dedup.confirm([rows])))
    assert calls < len(rows)
    for width in (5, 8):  # sets of wide elements too, and a slice
        column = pa.array(packed if width == 5 else
                          [b"".join(bytes(3) + p[k:k + 5] for k in range(0, len(p), 5)) for p in [b"", *packed]])
        assert cross_blocks.Contents(column[-1500:], width).similar(a, b, 75).tolist() == want

    cells, unknown = 800, bytes([para_dedup.MANY, *bytes(7)])  # a member, and an outsider on both sides
    cell = np.repeat(np.arange(cells), 3)
    first = np.arange(cells) * 40 % 1480
    other = np.where(np.arange(cells) % 100, (first + 1) % 1480, first)
    side = np.tile([0, 0, 1], cells)
    outsider = np.tile([False, True, True], cells)
    ident = 2 * cell + outsider
    content = [packed[x] for f, o in zip(first, other) for x in (f, o, o)]
    zero = pa.array(np.zeros(3 * cells, np.int32))
    table = pa.RecordBatch.from_arrays(
        [pa.array([int(c).to_bytes(8, "big") for c in cell]), zero, zero, pa.array(side.astype(np.int32)),
         pa.array(outsider), pa.array(ident), pa.array(ident), pa.array([unknown] * len(cell)), pa.array(content)],
        ["group", "i", "j", "side", "outsider", "id", "label", "sketch", "content"])
    got, calls = _calls(lambda: list(cross_blocks._confirmed(para_dedup.Sketches, 5, 75)([table])))
    links = sorted(sorted((r["a"], r["b"])) for b in got for r in b.to_pylist())
    similar = [k for k in range(cells) if raw[first[k]] and raw[other[k]]
               and 100 * len(raw[first[k]] & raw[other[k]]) >= 75 * len(raw[first[k]] | raw[other[k]])]
    assert links == [[2 * k, 2 * k + 1] for k in similar] and links
    assert calls < cells


def test_whole_short_texts_lines_and_changed_paragraphs_are_found(spark):
    rows, pairs = [], []
    def pair(a, b):
        pairs.append((len(rows), len(rows) + 1))
        rows.extend([(len(rows), a), (len(rows) + 1, b)])
    for n in range(24, 50):
        for seed in range(4):
            t = prose(9000 + 10 * n + seed, n, 9000)
            pair(t, t)                                # an equal text
            t = prose(50000 + 10 * n + seed, n, 9000)  # an equal line
            k = 100000 + 3 * len(rows)
            pair(f"{prose(k, 90, 9000)}\n{t}\n{prose(k + 1, 40, 9000)}", f"{t}\r\n{prose(k + 2, 200, 9000)}")
    for seed in range(20):
        w = prose(20000 + seed, 60, 9000).split(" ")
        other = [*w[:30], "changed", *w[31:]]
        a, b = " ".join(w), " ".join(other)
        pair(f"{prose(seed + 500, 80, 9000)}\n{a}", f"{b}\n{prose(seed + 600, 80, 9000)}")
        wrapped = ["\n".join(" ".join(x[k:k + 12]) for k in range(0, 60, 12)) for x in (w, other)]
        pair(f"new{seed} {prose(seed + 700, 80, 9000)}\n\n{wrapped[0].upper()} u{seed}", f"{wrapped[1].upper()} u{seed}\n\nold{seed} {prose(seed + 800, 80, 9000)}")
    df = documents(spark, rows)
    got = {r.doc_id for r in para_dedup.by_document(para_dedup.repeats(df)).collect()}
    exact = {i for i, j in pairs[:208]} | {j for i, j in pairs[:208]}
    near = [p for p in pairs[208:] if set(p) <= got]
    assert exact <= got and len(near) >= 0.8 * len(pairs[208:])
    text = {r.doc_id: r.text for r in para_dedup.remove(df).collect()}
    assert all(text[i] == rows[i][1] and len(text[j]) < len(rows[j][1]) - 60 for i, j in pairs[:208])


def test_all_pairs_of_large_mixed_bands_are_looked_at(spark):
    opening, texts = prose(70000, 20, 9000), []
    for k in range(150):  # one opening, and continuations of which two are alike
        w = f"{opening} {prose(71000 + k, 9, 90000)}".split(" ")
        texts += [" ".join(w), " ".join([*w[:-1], f"other{k}"])]
    near = prose(72000, 60, 9000).split(" ")  # and a family of near copies, many a paragraph
    texts += [" ".join([*near[:-1], f"end{k}"]) for k in range(100)]
    rows = list(enumerate(texts))
    found = para_dedup.repeats(documents(spark, rows)).collect()
    got = {r.doc_id: r.cluster for r in found if (r.start, r.end) == (0, len(texts[r.doc_id].encode()))}
    want = brute.near_duplicates(texts)[1]
    assert sorted(collections.Counter(want).values()) == [2] * 150 + [100]
    joined = collections.Counter((got.get(i), want[i]) for i in got)
    assert len({c for c, _ in joined}) == len(joined) == len({w for _, w in joined})  # no cluster is more or less
    assert len(joined) >= 0.98 * 151 and max(joined.values()) == 100
    s = [textblocks.text_sets(pa.array(texts[:40]))]
    sets = list(s[0])
    at = np.concatenate([[0], np.cumsum([len(v) for v in sets])])
    sk = para_dedup.sketch(np.concatenate(sets), at)
    sketches = para_dedup.Sketches(sk.view(np.uint64))
    for i in range(40):
        ok = sketches.scores(i, np.arange(40)) > 0
        assert all(ok[j] for j in range(40) if want[i] == want[j])


def test_clusters_and_removed_spans_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text]
    units, sets, kinds = [], [], []  # every unit of the operator, its set, and whether it is a whole line
    for i, text in rows:
        for _, _, data, off in textblocks.blocks(pa.array([text])):
            _, a, b, inside, at, entire = para_dedup.paragraphs(data, off)
            units += [(i, int(x), int(y)) for x, y in zip(a, b)]
            sets += [frozenset(inside[p:q].tolist()) for p, q in zip(at[:-1], at[1:])]
            kinds += entire.tolist()
    where, links = collections.defaultdict(list), []
    for n, s in enumerate(sets):  # lines and runs are compared with their own sort, and where they are equal
        both = collections.Counter(m for x in s for m in where[x])
        links += [(n, m) for m, c in both.items() if 100 * c >= 75 * (len(s) + len(sets[m]) - c)
                  and (kinds[n] == kinds[m] or s == sets[m])]
        for x in s:
            where[x].append(n)
    root = brute.roots(len(sets), links)
    members = collections.defaultdict(set)
    for n, r in enumerate(root):
        members[r].add(units[n])
    repeated = {frozenset(m) for m in members.values() if len({u[0] for u in m}) > 1}
    found = para_dedup.repeats(docs).collect()
    got = collections.defaultdict(set)
    for r in found:
        got[r.cluster].add((r.doc_id, r.start, r.end))
    assert {frozenset(m) for m in got.values()} == repeated
    gone = collections.defaultdict(list)
    for m in repeated:
        first = min(m)
        for u in m:
            if not (u[0] == first[0] and u[1] < first[2] and u[2] > first[1]):
                gone[u[0]].append(u[1:])
    whole = {(r.doc_id, r.start, r.end) for r in found if r.removed}
    assert {(i, *s) for i, spans in gone.items() for s in spans} <= whole
    for i, a, b in whole - {(i, *s) for i, spans in gone.items() for s in spans}:
        cut = set().union(*(range(x, y) for x, y in gone[i])) & set(range(a, b))
        assert 2 * len(cut) > b - a  # a first occurrence that others cut out anyway


def test_remove_with_clashing_column_names(odd):
    docs = odd
    for c in ("__id", "__spans", "id", "spans", "doc", "cluster", "removed", "first"):
        docs = docs.withColumn(c, F.lit("x"))
    cut = para_dedup.remove(docs)
    assert cut.columns == docs.columns
    want = collections.Counter((r.doc_id, r.text) for r in para_dedup.remove(odd).collect())
    assert collections.Counter((r.doc_id, r.text) for r in cut.collect()) == want


def test_paragraphs_of_odd_rows_and_nothing(odd, none):
    rows = para_dedup.by_document(para_dedup.repeats(odd)).collect()
    assert {7, 8, 9} <= {r.doc_id for r in rows} and not {0, 1, 2, 3, 12, 14, None} & {r.doc_id for r in rows}
    assert para_dedup.remove(odd).count() == odd.count()
    assert para_dedup.repeats(none).count() == 0 and para_dedup.remove(none).count() == 0


# -- ops 4 and 7 ------------------------------------------------------------

def labelled(spark, n=400):
    rows, marks = [], []
    for k in range(n):
        toxic, bad = k % 7 == 0, k % 5 == 0
        text = prose(3000 + k, 60 + k % 90, 3000)
        text += " badword" * toxic if k % 2 else " vilestem" + "abc"[k % 3] * toxic if toxic else ""
        if bad:
            text = " ".join(w.upper() + "!!" for w in text.split(" "))
        rows.append((k, text))
        marks.append((k, int(not bad), int(toxic)))
    marks += [(5, None, None), (None, 1, 1), (10**6, 1, 1)]
    return documents(spark, rows), spark.createDataFrame(marks, LABELS)


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("op,label,mod,fold", [(toxicity_pu, "toxic", 4, 2), (knn_quality, "quality", 3, 1)])
def test_classifiers_hold_out_score_and_odd_rows(spark, odd, odd_rows, none, op, label, mod, fold):
    docs, labels = labelled(spark)
    model = op.train(clashing(docs), labels)
    truth = {r.doc_id: r[label] for r in labels.filter("doc_id < 1000").collect() if r[label] is not None}
    rows = op.score(clashing(docs), model).collect()
    assert len(rows) == 400 and all(r.held_out == (brute.crc(r.doc_id) % mod == fold) for r in rows)
    assert auc([(r.score, truth[r.doc_id]) for r in rows if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= op.THRESHOLD) for r in rows)
    got = op.score(odd, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert op.score(none, model).count() == 0
    empty = op.train(none, labels.limit(0))
    assert {r.score for r in op.score(odd, empty).collect()} == ({0.0} if op is toxicity_pu else {0.5})


def test_held_out_labels_are_never_read(spark):
    docs, labels = labelled(spark, 120)
    turned = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2,
                                               1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity_pu.train(docs, labels), toxicity_pu.train(docs, turned)
    assert (a.keys == b.keys).all() and np.allclose(a.weights, b.weights)


def test_pu_risk_finds_positives_hidden_in_the_unlabelled():
    rng = np.random.default_rng(0)
    noise = lambda: rng.integers(100, 5000, 40).astype(np.uint64)
    positive = [np.unique(np.append(noise(), np.uint64(7))) for _ in range(200)]
    unlabelled = [np.unique(np.append(noise(), np.uint64(7 if k % 10 == 0 else 8))) for k in range(1000)]
    model = toxicity_pu.PULinear.train(positive, unlabelled, prior=0.1)
    assert 7 in model.keys and model.weights[list(model.keys).index(7)] > 3 and model.bias < 0


# -- op 5 -------------------------------------------------------------------

def vectors(n=600, dims=12):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, dims))
    x[100:250] = x[0] + 0.1 * rng.normal(size=(150, dims))
    x[300:340] = 3 * x[300]                     # equal vectors
    x[340:360] = x[300] + 0.4 * rng.normal(size=(20, dims))
    return x


@pytest.mark.parametrize("chunk", [8192, 64])
def test_cosine_links_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(cover_tree, "CHUNK", chunk)
    x = vectors()
    odd = [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [math.nan] + [1.0] * 11), (1004, [math.inf] + [1.0] * 11),
           (1005, [None] + [1.0] * 11), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, x[0].tolist())]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5, x[5].tolist())] + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("n", F.lit(1))
    got = cover_tree.near_duplicates(df).collect()
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    root = brute.roots(len(x), np.argwhere(np.tril(link, -1)))
    want = {k: (int(link[k].sum()) - 1, root[k]) for k in range(len(x))}
    want |= {k: (0, k) for k in range(1000, 1006)} | {1006: (1, 1006), 1007: (1, 1006), None: (0, None)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_vectors(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_cover_tree_levels_are_nested_and_cover():
    tree = cover_tree.CoverTree(cover_tree.unit(vectors()))
    n = len(tree.points)
    for level, (s, r) in enumerate(zip(tree.start[:-1], tree.bounds)):
        centre = np.repeat(s, np.diff(np.append(s, n)))
        far = np.linalg.norm(tree.points - tree.points[centre], axis=1)
        assert far.max() <= r + 1e-9
        assert np.isin(s, tree.start[level + 1]).all()


# -- op 6 -------------------------------------------------------------------

def test_surrogates_keep_type_format_and_coreference():
    s = pii.Surrogates(b"k")
    text = ('Mail a.b.19@mail5.example.com or A.B.19@MAIL5.EXAMPLE.COM, +1 (743) 555-3824 = 743-555-3824, 227.5.221.1!! '
            '4539578763621486 4539-5787-6362-1486 token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" '
            "Mr. John Smith, Mrs Smith; господин Иванов 123-45-6789")
    new, kinds = pii.replace(text, s, {})
    assert collections.Counter(kinds) == {"email": 2, "phone": 2, "ip": 1, "card": 2, "secret": 1, "given": 1, "surname": 3, "ssn": 1}
    old, got = pii.spans(text), pii.spans(new)
    assert [k for _, _, k in old] == [k for _, _, k in got]
    value = [pii.canonical(k, new[a:b]) for a, b, k in got]
    assert value[0] == value[1] and value[2] == value[3] and value[5] == value[6]
    assert all(pii.canonical(k, text[a:b]) != v for (a, b, k), v in zip(old, value))
    assert pii.luhn(pii.canonical("card", "4539578763621486")) == pii.luhn(value[5]) and value[5][0] == "4"
    assert pii.replace(text, pii.Surrogates(b"k"), {})[0] == new != pii.replace(text, pii.Surrogates(b"l"), {})[0]


def test_permutations_are_bijections():
    s = pii.Surrogates()
    for size in (2, 3, 26, 100, 1000):
        assert sorted(s.permute(x, size, "t") for x in range(size)) == list(range(size))


def test_collisions_are_drawn_again(spark):
    s = pii.Surrogates()
    first = s.of("ssn", "123456789", 0)
    rows = [("ssn", "123456789"), ("ssn", first)] + [("surname:latin", f"name{k}") for k in range(3000)]
    got = pii.assign(spark.createDataFrame(rows, pii.ENTITIES)).collect()
    values = {r.value for r in got}
    assert len(got) == len(rows) and len({(r.kind, r.surrogate) for r in got}) == len(rows)
    assert not values & {r.surrogate for r in got} and max(r.attempt for r in got) > 0
    docs = documents(spark, [(1, "a 123-45-6789 b"), (2, f"{first[:3]}-{first[3:5]}-{first[5:]}"), (3, "clean")])
    out = {r.doc_id: r.text for r in pii.anonymise(docs).collect()}
    assert out[3] == "clean" and out[2] not in out[1] and first[:3] + "-" + first[3:5] not in out[1]


def test_given_names_never_share_a_surrogate(spark):
    names = sorted({f"{a}{b}{c}".title() for a in pii.SYLLABLES["latin"] for b in pii.SYLLABLES["latin"] for c in ("", "o", "ia", "el", "is", "yn", "e")})
    names = [n for v in pii.GIVEN.values() for n in v] + names[:2000]
    titles = ["Mr", "Mrs", "Dr"]
    docs = documents(spark, [(k, f"met {titles[k % 3]} {n} Doe, {titles[k // 3 % 3]}. {n} Doe") for k, n in enumerate(names)])
    got = {r.doc_id: r.text for r in pii.anonymise(docs).collect()}
    new = {}
    for k, n in enumerate(names):
        first, second = (got[k][a:b] for a, b, kind in pii.spans(got[k]) if kind.startswith("given"))
        assert first == second == new.setdefault(n, first)
    assert len(set(new.values())) == len(new) and not set(new.values()) & set(new)


def test_fields_without_letters_are_no_secrets_and_full_formats_lengthen(spark):
    blank = f"password: {'_' * 20} token = {'-' * 16}"
    mails = [f"_@{k}.com" for k in range(10)]
    docs = documents(spark, [(1, blank)] + [(2 + k, m) for k, m in enumerate(mails)])
    got = {r.doc_id: r.text for r in pii.anonymise(docs).collect()}
    assert got.pop(1) == blank
    assert len(set(got.values())) == 10 and not set(got.values()) & set(mails)


@pytest.mark.parametrize("text, entities", [
    ("dns is 8.8.8.8", ["8.8.8.8"]), ("1.1.1.1", ["1.1.1.1"]), ("ip ٣.٣.٣.٣", ["٣.٣.٣.٣"]),
    ("pay 4 5 3 9 5 7 8 7 6 3 6 2 1 4 8 6 now", ["4 5 3 9 5 7 8 7 6 3 6 2 1 4 8 6"]), ("id ١٢٣-٤٥-٦٧٨٩", ["١٢٣-٤٥-٦٧٨٩"]),
    ("Mr. McDonald's", ["McDonald"]), ("Mr O'Neil, Mr O’Neil", ["O'Neil", "O’Neil"]), ("Mr. Šimek", ["Šimek"]),
    ("Mr S\u030cimek", ["S\u030cimek"]), ("MR SMITH.", ["SMITH"]), ("MS Office, MS ROE", ["ROE"]),
    ("Mrs Jean-Paul left", ["Jean-Paul"]), ("Dr Παπαδόπουλος", ["Παπαδόπουλος"]), ("Mr Smith's", ["Smith"]),
    ("Mrs Anne-Marie O'Brien-Łukasz", ["Anne-Marie", "O'Brien-Łukasz"]), ("mail 王小明@example.com", ["王小明@example.com"]),
    ("mail İŞTE@X9.com", ["İŞTE@X9.com"]), ("मोहन@example.org", ["मोहन@example.org"]), ("Mr. who", [])])
def test_detections_in_any_script_are_whole_and_replaced(text, entities):
    found = pii.spans(text)
    assert [text[a:b] for a, b, kind in found] == entities
    new, kinds = pii.replace(text, pii.Surrogates(), {})
    assert len(kinds) == len(found) and [k for *_, k in pii.spans(new)] == [k for *_, k in found]
    assert not any(old in new for old in entities)
    for (a, _, kind), (c, _, _) in zip(found, pii.spans(new)):
        assert kind != "email" or text[a:].split("@")[0] != new[c:].split("@")[0]


def test_mentions_of_one_entity_corefer_in_other_forms():
    for kind, forms in (("surname:latin", ("O'Neil", "O’Neil", "O'NEIL")), ("surname:latin", ("Šimek", "S\u030cimek")),
                        ("ip", ("3.3.3.3", "٣.٣.٣.٣")), ("ssn", ("123-45-6789", "١٢٣-٤٥-٦٧٨٩")), ("email", ("İa@B.com", "İA@b.com"))):
        assert len({pii.canonical(kind, f) for f in forms}) == 1


def test_anonymise_odd_rows_and_nothing(odd, odd_rows, none):
    got = pii.anonymise(clashing(odd)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(odd_rows)
    assert {r.n_entities for r in got} == {0} and pii.anonymise(none).count() == 0
    same = pii.anonymise_column(clashing(odd))
    assert same.columns == clashing(odd).columns and same.count() == len(odd_rows)


# -- op 8 -------------------------------------------------------------------

def test_containment_equals_brute_force(spark, odd, odd_rows, none):
    items = [(1, prose(400, 12)), (2, prose(401, 40)), (3, prose(402, 150)), (4, "a b c d"), (5, ""), (6, None),
             (7, prose(403, 7)), (7, prose(404, 9)), (None, prose(405, 20))]
    rows = list(odd_rows)
    for k, (_, t) in enumerate(items):
        if t:
            rows.append((500 + k, f"{prose(k, 5000)} {t} {prose(k + 50, 3000)}"))
            rows.append((600 + k, edited(t, k, 0.04) + " " + prose(k, 900)))
            rows.append((700 + k, edited(t, k, 0.3)))
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = collections.Counter()
    for i, t in rows:
        own = brute.shingles(t)
        for j, u in items:
            s = brute.shingles(u)
            if s and 100 * len(s & own) >= 75 * len(s):
                want[i, j, len(s), len(s & own)] += 1
    for size in (decontam.BLOCK_BYTES, 300):  # one block of items, and several
        got = decontam.matches(clashing(docs), bench, block_bytes=size).collect()
        assert collections.Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got) == want
        left = decontam.clean_documents(docs, bench, block_bytes=size)
        assert left.columns == docs.columns
        hit = {k[0] for k in want}
        assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in hit)
    assert decontam.matches(docs, bench.limit(0)).count() == 0 and decontam.matches(none, bench).count() == 0


# -- op 9 -------------------------------------------------------------------

def reference_encoder():
    import base64

    import public_tokenizers
    import tiktoken
    with open(vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_library_on_random_text():
    import random
    r = random.Random(3)
    alphabet = list("  \n\t\r'''''strevldmSTABCé ß12²½٣,.!?-_中文　\x1c\x85🙂́x y")
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(30))) for _ in range(4000)]
    texts += ["<|endoftext|>", "it's we'll they've I'd 'tis ''s don't'", "", " ", "a" * 20000, " " * 9000, "'re", None]
    bpe, want = bbpe.ByteBPE.from_file(vocabulary_path()), reference_encoder()
    for t, ids in zip(texts, bpe.encode_column(pa.array(texts))):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == want.encode_ordinary(t or "")
        assert bpe.decode_bytes(ids) == (t or "").encode()


def test_bpe_cuts_every_pair_after_an_apostrophe_as_the_public_library():
    import string
    after = [chr(c) for c in range(1, 0x3A00)]
    texts = [" ".join(f"'{a}{b}n" for b in after) for a in string.ascii_letters] + ["'k\u00ecn", "'D\u1765"]
    bpe, want = bbpe.ByteBPE.from_file(vocabulary_path()), reference_encoder()
    for t, ids in zip(texts, bpe.encode_column(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(t)


def test_bpe_digests(odd, odd_rows, none):
    got = bbpe.digest_documents(clashing(odd), vocabulary_path()).collect()
    want = reference_encoder()
    expected = collections.Counter()
    for i, t in odd_rows:
        ids = np.array(want.encode_ordinary(t or ""), "<u4").tobytes()
        expected[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in got) == expected
    assert bbpe.digest_documents(none, vocabulary_path()).count() == 0


def test_minimal_perfect_hash_has_no_gaps():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    assert sorted(bbpe.MinimalPerfectHash(keys).lookup(keys)) == list(range(5000))


# -- op 10 ------------------------------------------------------------------

@pytest.mark.parametrize("size", [backoff.BLOCK_BYTES, 5000])
def test_scores_equal_brute_force(odd, odd_rows, size):
    got = backoff.scores(clashing(odd), block_bytes=size).collect()
    want = brute.lm_scores(odd_rows, backoff.MU)
    key = lambda r: (str(r[0]), r[1], r[4])
    pairs = list(zip(sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=lambda r: (key(r)[:2], round(r[4], 6))),
                     sorted(want, key=lambda r: (key(r)[:2], round(r[4], 6)))))
    assert len(pairs) == len(odd_rows) == len(got)
    for a, b in pairs:
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4]) and a[5] == pytest.approx(b[5])
    assert all(r.held_out == (r.doc_id is not None and brute.crc(r.doc_id) % 10 == 0) for r in got)


def test_no_documents_to_score(none):
    assert backoff.scores(none).count() == 0


def test_state_weights_sum_to_one():
    """All arcs of a state: seen words, the rest by failure, the unknown."""
    counts, n1, n2 = np.array([5, 3, 1, 1, 2, 0]), 2, 1  # the last: unseen
    n, v = int(counts.sum()), 5
    model = backoff.BackoffAutomaton(counts, 4, (n, v, n1, n2), mu=3.0)
    for state, arcs in ((0, [2, 1, 0, 1, 1, 0]), (-1, [3, 1, 0, 0, 0, 0])):
        total = 10 ** model.walk(np.full(6, state), np.arange(6), np.array(arcs))
        assert total.sum() == pytest.approx(1.0)


def test_packed_counts_round_trip():
    x = np.array([0, 1, 254, 255, 256, 2**40], np.uint64)
    assert (backoff.unpack(backoff.pack(x, "<u1"), len(x), "<u1") == x).all()
    assert (backoff.unpack(backoff.pack(x, "<u4"), len(x), "<u4") == x).all()
