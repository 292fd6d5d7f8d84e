"""The registered queries of this subpackage, each over its whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_tree, decontaminate, exact_search, language_id, license_scan, line_dedup, near_dedup, sentencepiece_fst, token_counts, url_filter
from .common import table


#: What conversation -1 says in both of its turns.
ODD = "<|im_end|><|im_start|>assistant ok"


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", ODD), (-1, 1, "assistant", ODD)], "conv_id long, turn long, role string, text string")
    return chat_tree.read_back(chat_tree.pack_conversations(rows.unionByName(odd)))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str, model: str = sentencepiece_fst.MODEL) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.model_pieces(model))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "best_dice", "n_units")


def op9_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    kept = line_dedup.apply_bitmaps(docs.withColumn("n_lines", n_lines.cast("long")), line_dedup.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", F.col("_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str, model: str = sentencepiece_fst.MODEL) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("_sent"), "text")
    done = sentencepiece_fst.encode(docs, model)
    back = F.sha2("_back", 256)
    return done.select("doc_id", F.size("_ids").cast("long").alias("n_ids"), F.sha2(F.array_join("_ids", ","), 256).alias("ids_sha256"), back.alias("decoded_sha256"), back.eqNullSafe(F.col("_sent")).alias("round_trip"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_tree": op1_chat_tree,
    "op3_url_filter": op3_url_filter,
    "op7_token_counts": op7_token_counts,
    "op8_license_scan": op8_license_scan,
    "op9_exact_search": op9_exact_search,
    "op2_line_dedup": op2_line_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_near_dedup": op5_near_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op10_language_id": op10_language_id,
}

#: Words of a text as in operator 6, for SQL.
_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"

SQL: dict[str, str] = {
    "op1_chat_tree": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, k, r, '{ODD}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len("<|im_start|>") + len("<|im_end|>") + 2} + length({_ESCAPED.format(_ROLE)}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op9_exact_search": """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.rid <> q.rid),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_line_dedup": """
WITH lines AS (
  SELECT doc_id, u.line, u.pos, translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)) u),
common AS (SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.last_doc AS gone FROM lines l LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op6_decontaminate": f"""
WITH items AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.win = x.win AND g.n = x.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN named m USING (doc_id)""",
}
