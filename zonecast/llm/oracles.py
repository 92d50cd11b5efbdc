"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = """list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"""


def _shingles(table: str, key: str) -> str:
    """Distinct five-word shingles; a shorter text is one shingle."""
    return f"""
    SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s
    FROM (SELECT {key}, {_WORDS} AS w FROM {table})"""


ORACLES: dict[str, str] = {}

ORACLES["op8_decontamination"] = f"""
WITH d AS ({_shingles("documents", "doc_id")}),
i AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""

ORACLES["op2_sharding"] = """
WITH k AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS key FROM documents),
p AS (SELECT *, key >> (32 - depth) AS prefix
    FROM k CROSS JOIN (SELECT unnest(range(0, 33)) AS depth)),
b AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM p GROUP BY depth, prefix)
SELECT doc_id, n_bytes, depth, prefix, 0::BIGINT AS page, shard_bytes
FROM p JOIN b USING (depth, prefix) WHERE shard_bytes <= 1048576 OR n = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""

_COMPONENTS = """
reach(node, other) AS (SELECT {node}, {node} FROM {nodes}
    UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other)
"""

ORACLES["op1_minhash_dedup"] = f"""
WITH RECURSIVE d AS ({_shingles("documents", "doc_id")}),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM d x JOIN d y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL),
edges AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= 75 * (na.n + nb.n - c)),
{_COMPONENTS.format(node="doc_id", nodes="documents")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN documents ON doc_id = node LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""

ORACLES["op5_embedding_dedup"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
edges AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
n AS (SELECT a AS vec_id, count(*) AS n FROM edges GROUP BY a),
{_COMPONENTS.format(node="vec_id", nodes="embeddings")}
SELECT vec_id, coalesce(n, 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach JOIN embeddings ON vec_id = node LEFT JOIN n USING (vec_id) GROUP BY vec_id, n
"""

ORACLES["op12_exact_dedup"] = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
