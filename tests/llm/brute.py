"""Plain Python versions of what the operators compute, and small inputs."""

import collections
import math
import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = words(text)
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def roots(n, links):
    """Smallest index reachable by links, for 0..n-1."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_duplicates(texts):
    s = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j]
             and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])]
    return [len(x) for x in s], roots(len(s), links)


def near_duplicates_by_index(texts):
    """The same through an index of shingles, for more texts."""
    s = [shingles(t) for t in texts]
    where = collections.defaultdict(list)
    links = []
    for i, x in enumerate(s):
        both = collections.Counter(j for y in x for j in where[y])
        links += [(i, j) for j, n in both.items() if 100 * n >= 75 * (len(x) + len(s[j]) - n)]
        for y in x:
            where[y].append(i)
    return [len(x) for x in s], roots(len(s), links)


def crc(i):
    return zlib.crc32(str(i).encode())


def lm_scores(docs, mu):
    """{id: (n_tokens, n_known, N, base, score)} of (id, text) rows."""
    uni, bi, starts = collections.Counter(), collections.Counter(), 0
    token = lambda t: words(t) + ["</s>"]
    for i, t in docs:
        if i is not None and crc(i) % 10 != 0:
            starts += 1
            uni.update(token(t))
            bi.update(zip(["<s>"] + token(t), token(t)))
    n, v = sum(uni.values()), len(uni)
    n1, n2 = (sum(c == k for c in uni.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    out = []
    for i, t in docs:
        base = score = known = 0
        h = "<s>"
        for w in token(t):
            c = uni[w]
            known += c > 0
            base += math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            p = (c - d) / n if c else d * v / n if n else 1.0
            ch = starts if h == "<s>" else uni[h]
            score += math.log10((bi[h, w] + mu * p) / (ch + mu))
            h = w
        out.append((i, len(token(t)), known, n, base, score))
    return out


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"e{r.randrange(10**6)}" for w in text.split(" "))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC_SCHEMA)
