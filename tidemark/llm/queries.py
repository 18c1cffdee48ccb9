"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    fingerprints,
    hard_negatives,
    html,
    language,
    merkle,
    neardup,
    packing,
    quality,
    simhash,
    token_store,
    warc,
)
from tidemark.llm.common import own_columns, table
from tidemark.llm.tokens import public_vocabulary
from tidemark.session import materialize

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.encode_documents(spark, table(spark, folder, "documents"), public_vocabulary())


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    own = own_columns(rows, conv_id="long", turn="long", role="string", text="string")
    return chat.digests(materialize(chat.format_conversations(own.union(planted)), "chat"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_next(table(spark, folder, "documents"))


def op4_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), percent=85)


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate(table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_vocabulary())


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.archive_pages(spark, table(spark, folder, "pages"))
    # Whatever cannot be read back is lost, so the query must not go on without it.
    lost = F.raise_error(F.concat(F.lit("a record cannot be read back: "), "problem")).cast("boolean")
    read = read.where(F.when(F.col("problem").isNull(), True).otherwise(lost))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("items", "spans")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = hard_negatives.integers(hard_negatives.shifted(table(spark, folder, "embeddings")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verify_documents(table(spark, folder, "documents"))


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def registry() -> dict[str, Query]:
    own = (
        op1_token_store, op2_chat, op3_fingerprints, op4_neardup, op5_html, op6_quality,
        op7_language, op8_packing, op9_warc, op10_decontamination, op11_hard_negatives, op12_merkle,
        op13_simhash,
    )
    return {query.__name__: query for query in own}


#: Words as the operators take them, from a text with A-Z lower-cased.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _escaped(text: str) -> str:
    tails = "|".join(re.escape(mark[1:]) for mark in sorted(chat.CONTROLS, key=len, reverse=True))
    return f"regexp_replace({text}, '([<\\[])(\\\\*)({tails})', '\\1\\\\\\2\\3', 'g')"


_CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat.OPEN) + len(chat.CLOSE) + 2} + length(role) + length({_escaped("text")}))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""

_NEARDUP = f"""
WITH RECURSIVE worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least AS component_id, d.doc_id = least AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a, min(b) AS least FROM reached GROUP BY a) r ON r.a = d.doc_id"""

_WARC = """
WITH own AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS least FROM own GROUP BY ALL)
SELECT page_id, strlen(html) AS payload_bytes, payload_digest,
  CASE WHEN strlen(html) >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(html) >= 100 AND page_id <> least THEN least END AS refers_to
FROM own JOIN firsts USING (payload_digest)"""

_LEAKS = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(
    list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS s
  FROM items WHERE len(w) > 0),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
  FROM docs CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS MATERIALIZED (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN windows v ON v.n = p.n
    AND v.s = array_to_string(p.w[i:i + p.n - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_NEGATIVES = """
WITH own AS MATERIALIZED (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_dot_product(a.code, b.code)::BIGINT AS score
  FROM own a JOIN own b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positives AS MATERIALIZED (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(_field(value) for value in fields) + ")"


_MERKLE = f"""
WITH RECURSIVE own AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda ch: [ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 5 = 0
    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM own),
low AS MATERIALIZED (
  SELECT 0 AS lvl, tree, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT lvl + 1, tree, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16
  FROM low WHERE n > 1 GROUP BY lvl, tree, pos // 16, n),
subs AS MATERIALIZED (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS MATERIALIZED (
  SELECT 100 AS lvl, pos, h, n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16
  FROM high WHERE n > 1 GROUP BY lvl, pos // 16, n),
asked AS (
  SELECT p.r, l.lvl, l.pos, l.h, (p.pos >> (4 * l.lvl)) AS spot FROM placed p JOIN low l
    ON l.tree = p.tree AND l.n > 1 AND (l.pos // 16) = (p.pos >> (4 * l.lvl + 4))
  UNION ALL
  SELECT p.r, t.lvl, t.pos, t.h, (s.pos >> (4 * (t.lvl - 100))) AS spot FROM placed p JOIN subs s USING (tree) JOIN high t
    ON t.n > 1 AND (t.pos // 16) = (s.pos >> (4 * (t.lvl - 100) + 4))),
steps AS MATERIALIZED (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY lvl) AS step,
    coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < spot), '') AS before,
    coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > spot), '') AS after
  FROM asked GROUP BY r, lvl),
folded AS (
  SELECT r, 0::BIGINT AS step, coalesce(forged, leaf) AS h FROM placed
  UNION ALL
  SELECT f.r, s.step, sha256(s.before || f.h || s.after) FROM folded f JOIN steps s ON s.r = f.r AND s.step = f.step + 1),
proofs AS (SELECT r, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY r)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
  e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN subs s USING (tree) JOIN (SELECT h FROM high WHERE n = 1) t ON true
LEFT JOIN proofs USING (r) JOIN (SELECT r, last(h ORDER BY step) AS h FROM folded GROUP BY r) e USING (r)"""


def oracle() -> dict[str, str]:
    """SQL for the queries that it can express; tests/llm has the others."""
    return {
        "op2_chat": _CHAT, "op4_neardup": _NEARDUP, "op9_warc": _WARC, "op10_decontamination": _LEAKS,
        "op11_hard_negatives": _NEGATIVES, "op12_merkle": _MERKLE,
    }
