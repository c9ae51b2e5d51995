"""The registered queries of this part, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.chat import format_chats
from tamiz.llm.codes import train_codes, with_label_errors
from tamiz.llm.common import table
from tamiz.llm.decontaminate import decontaminate
from tamiz.llm.html_text import extract_text
from tamiz.llm.lines import drop_repeated_lines
from tamiz.llm.maxscore import top_k
from tamiz.llm.pack import pack_documents
from tamiz.llm.pii import KINDS, pseudonymised_spans
from tamiz.llm.simhash import near_duplicates
from tamiz.llm.spelling import spelling_groups
from tamiz.llm.substrings import deduplicate
from tamiz.llm.tokens import count_tokens
from tamiz.llm.toxicity import held_out, toxicity

SEQUENCE = 2048
# A key of the tests; a job passes its own.
PII_KEY = b"tamiz test key"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, score = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"),
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, text = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", text, F.length(text).cast("long").alias("n_chars"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the text with pseudonyms and how many of each kind."""
    found = pseudonymised_spans(table(spark, sf_dir, "documents"), PII_KEY)
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in KINDS]
    return found.select("doc_id", "text", F.size("spans").cast("long").alias("n_found"), *counts)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)
    return found.withColumnRenamed("id", "vec_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = train_codes(table(spark, sf_dir, "embeddings"))
    return with_label_errors(codes).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), slip_every=97)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, lines = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", f"{lines}.n_lines", f"{lines}.n_dropped", F.sha2(F.col(f"{lines}.kept").cast("binary"), 256).alias("kept_sha256")
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_substrings, op3_toxicity, op4_main_text, op5_token_counts, op6_chat_format, op7_pii, op8_pack, op9_simhash, op10_top_k, op11_vector_codes, op12_spelling, op13_line_dedup)
}

WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {WORDS} AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS line
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents),
place AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS line
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM pattern))
),
hit AS (SELECT r, place.n, i, item_id FROM place JOIN pattern ON place.n = pattern.n AND place.line = pattern.line),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS line
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(line, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

OP10 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
term AS (SELECT r, vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM v),
score AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.r AS cr, c.vec_id AS vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM term q JOIN term c ON q.i = c.i AND q.r <> c.r WHERE q.vec_id % 20 = 0 GROUP BY ALL
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM score)
WHERE rank <= 20
"""

OP2 = """
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS k, doc_id, hex(encode(coalesce(text, ''))) AS h
  FROM documents
),
place AS (SELECT r, k, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM doc),
string AS (SELECT r, k, i, substr(h, 2 * i + 1, 100) AS s FROM place),
first AS (SELECT s, min(k) AS m FROM string GROUP BY s HAVING min(k) < max(k)),
hit AS (SELECT r, i FROM string JOIN first USING (s) WHERE m < k),
step AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
part AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM step),
run AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM part GROUP BY r, g),
gap AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS p FROM run),
kept AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head
  FROM gap JOIN doc USING (r) GROUP BY r
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

OP6 = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS l
  FROM t GROUP BY conv_id
),
one AS (SELECT min(conv_id) AS conv_id, n, l FROM c GROUP BY n, l),
kept AS (
  SELECT * FROM one a
  WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.n > a.n AND b.l[1] = a.l[1] AND b.l[1:a.n] = a.l)
),
line AS (
  SELECT conv_id, n, unnest(l) AS x, unnest(range(0, n)) AS i FROM kept
)
SELECT conv_id, CAST(i // 256 AS INTEGER) AS part, n AS n_turns,
  string_agg('<|im_start|>' || replace(coalesce(x.role, ''), '<|', '< |') || chr(10)
    || replace(coalesce(x.text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY i) AS text
FROM line GROUP BY conv_id, i // 256, n
"""



def _codes_sql(rounds: int = 6) -> str:
    """Lloyd rounds as chained tables: c<n> are the entries after n rounds, a<n> what is nearest to them."""
    parts = [
        """
v AS (
  SELECT row_number() OVER () AS r, vec_id, label, len(embedding) // 8 AS width,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS (
  SELECT r, (i - 1) // width AS p, (i - 1) % width AS i, x
  FROM (SELECT r, width, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM v)
),
c0 AS (
  SELECT p, k, i, x AS c
  FROM x JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS k FROM v ORDER BY k LIMIT 16) USING (r)
)"""
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""
a{n} AS (
  SELECT r, p, min(16 * d + k) % 16 AS k, min(16 * d + k) // 16 AS d
  FROM (SELECT r, x.p, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN c{n} AS c ON x.p = c.p AND x.i = c.i GROUP BY r, x.p, k)
  GROUP BY r, p
)"""
        )
        if n < rounds:
            parts.append(
                f"""
c{n + 1} AS (
  SELECT c.p, c.k, c.i, coalesce((s - ((s % m + m) % m)) // m, c) AS c
  FROM c{n} AS c LEFT JOIN (
    SELECT x.p, k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m FROM x JOIN a{n} AS a ON x.r = a.r AND x.p = a.p GROUP BY ALL
  ) AS m ON c.p = m.p AND c.k = m.k AND c.i = m.i
)"""
            )
    return f"""
WITH {",".join(parts)},
code AS (SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  sha256((SELECT string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, i) FROM c{rounds})) AS codebooks_sha256
FROM v JOIN code USING (r)
"""


OP13 = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM doc),
named AS (
  SELECT r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM line
),
often AS (
  SELECT k, max(doc_id) AS top FROM named WHERE len(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3
),
marked AS (
  SELECT r, i, line, often.k IS NOT NULL AND (doc_id IS NULL OR doc_id < top) AS gone FROM named LEFT JOIN often USING (k)
),
kept AS (
  SELECT r, count(*) AS n_lines, count_if(gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM doc JOIN kept USING (r)
"""

LLM_ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1,
    "op2_substrings": OP2,
    "op6_chat_format": OP6,
    "op10_top_k": OP10,
    "op11_vector_codes": _codes_sql(),
    "op13_line_dedup": OP13,
}
