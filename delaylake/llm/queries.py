"""The registered queries opN_<name> of the operators, thin digests of their outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.llm import bpe as op4
from delaylake.llm import conversation_trie as op11
from delaylake.llm import decontaminate as op8
from delaylake.llm import jaccard_join as op3
from delaylake.llm import kd_sharding as op6
from delaylake.llm import langid as op7
from delaylake.llm import lexical_search as op13
from delaylake.llm import odd_sketch as op12
from delaylake.llm import quality as op5
from delaylake.llm import substring_dedup as op1
from delaylake.llm import toxicity as op10
from delaylake.llm import url_filter as op9
from delaylake.llm import warc as op2
from delaylake.llm.base import crc_bucket, table

SUBSTRING_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p,
          row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM rep),
lost AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN qs IS NULL THEN w ELSE
         list_filter(w, lambda x, i: NOT list_contains(qs, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT html, max(page_id) AS top FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id < top THEN top END AS refers_to
FROM p JOIN m USING (html)
"""

JACCARD_JOIN_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, least(5, len(w)) AS k, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.k = b.k
      AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
      WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
r AS (SELECT doc_id AS a, doc_id AS z FROM d UNION SELECT r.a, l.v FROM r JOIN l ON r.z = l.u)
SELECT a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(z) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY a
"""

CONVERSATION_TRIE_SQL = """
WITH RECURSIVE o AS (SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS turn_, row_number()
    OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(turn_ ORDER BY p) AS ts FROM o GROUP BY conv_id),
-- crc32, bit by bit: each byte is added at its first of eight shifts
x AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS z FROM l
  UNION ALL SELECT conv_id, s, i + 1, CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(z, ascii(s[i // 8 + 1])) ELSE z END AS y FROM x WHERE i < 8 * len(s))),
h AS (SELECT conv_id, CAST(xor(z, 4294967295) % 6 AS INTEGER) AS h FROM x WHERE i = 8 * len(s)),
c AS (SELECT l.conv_id, list_concat(coalesce(b.ts, [])[1:h], l.ts[h + 1:]) AS ts
  FROM l JOIN h USING (conv_id) LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 100),
m AS (SELECT conv_id, len(ts) AS n, d, ts[1:d] AS k FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM c)),
n AS (SELECT min(conv_id) AS c, d, k, count(*) AS n_convs, count(*) FILTER (n = d) AS n_ends,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM m GROUP BY d, k),
e AS (SELECT n.*, p.c AS pc, (n.n_convs - 1) * CASE WHEN n.d = 0 THEN 0 ELSE length(n.k[n.d].t) END AS saved
  FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]),
f AS (SELECT c, d, (SELECT count(*) FROM e z WHERE z.d = e.d + 1 AND z.pc = e.c) AS kids FROM e),
w AS (SELECT a.c, a.d, count(*) FILTER (f.kids = 0) AS n_leaves, sum(b.saved) AS saved
  FROM e a JOIN e b ON b.d >= a.d AND b.k[1:a.d] = a.k JOIN f ON f.c = b.c AND f.d = b.d GROUP BY a.c, a.d)
SELECT e.c AS conv_id, CAST(e.d AS BIGINT) AS depth, e.pc AS parent_conv_id, e.n_convs, f.kids AS n_children,
  w.n_leaves, CAST(w.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM e JOIN f ON f.c = e.c AND f.d = e.d JOIN w ON w.c = e.c AND w.d = e.d
"""

ODD_SKETCH_SQL = f"""SELECT *, doc_id = component_id AS kept
FROM ({JACCARD_JOIN_SQL.replace("100 * n_both >= 75", "100 * n_both >= 85")})
"""

LEXICAL_SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
k AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, s GROUP BY t),
p AS (SELECT item_id, f.r, doc_id, CAST(sum(k.w * ((1000000000 * tf) // (1000 * tf
        + 20 * (100 - 50 + (50 * len(d.w) * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN f USING (t) JOIN k USING (t) JOIN d ON d.r = f.r, s GROUP BY item_id, f.r, doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 50
"""

DECONTAMINATE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS k,
         array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
f AS (SELECT dw.doc_id, dw.p, dw.k, bw.item FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM
        (SELECT doc_id, unnest(range(p, p + k)) AS q FROM f) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.jaccard_join(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.encode(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_pattern(),
                      with_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op5.quality(docs, op5.fit_quality(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "content_share")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.kd_sharding(table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = op7.training_texts(docs, crc_bucket("doc_id", 3) != 1)
    return op7.identify(docs, texts).select(
        "doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.url_filter(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op10.fit_toxicity(docs, table(spark, sf_dir, "labels"), crc_bucket("doc_id", 4) != 2)
    offsets = F.transform("spans", lambda x: F.concat_ws("-", x.begin.cast("string"), x.end.cast("string")))
    return op10.toxicity(docs, model).select(
        "doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.array_join(offsets, ","), 256).alias("offsets_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.near_dedup(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_warc": op2_warc,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_kd_sharding": op6_kd_sharding,
    "op7_langid": op7_langid,
    "op8_decontaminate": op8_decontaminate,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_odd_sketch": op12_odd_sketch,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING_DEDUP_SQL,
    "op2_warc": WARC_SQL,
    "op3_jaccard_join": JACCARD_JOIN_SQL,
    "op8_decontaminate": DECONTAMINATE_SQL,
    "op11_conversation_trie": CONVERSATION_TRIE_SQL,
    "op12_odd_sketch": ODD_SKETCH_SQL,
    "op13_lexical_search": LEXICAL_SEARCH_SQL,
}
