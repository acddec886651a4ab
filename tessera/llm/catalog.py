"""The ``opN_*`` queries of this folder over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, html_extract, jaccard_join, line_dedup, lm_score, packing, quality, sharding, simhash,
               source_audit, topk, whitening)
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return out.select("doc_id", "n_lines", removed.alias("n_removed"), F.length("text").cast("long").alias("n_chars"),
                      F.sha2(F.col("text"), 256).alias("text_sha256"))


OP1 = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''),
s AS (SELECT doc_id, ls, least(3, len(ls)) AS k FROM l),
w AS (SELECT doc_id, k, i, list_slice(ls, i, i + k - 1) AS win
      FROM (SELECT doc_id, ls, k, unnest(range(1, len(ls) - k + 2)) AS i FROM s)),
r AS (SELECT doc_id, k, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w
      WHERE regexp_matches(array_to_string(win, ''), '[^\x09-\x0D ]')),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM r WHERE n > 1),
x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM l),
kept AS (SELECT x.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY x.i) AS t FROM x
         ANTI JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY x.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       CASE WHEN l.doc_id IS NULL THEN 0 ELSE len(l.ls) - coalesce(kept.n, 0) END::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(kept.t, '')) END::BIGINT AS n_chars,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(kept.t, '')) END AS text_sha256
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.shard_by_bytes(rows, 8, F.col("size"), ["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


OP2 = r"""
WITH RECURSIVE steps(i, k, x) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(x ORDER BY i) AS tab FROM steps WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents),
b AS (SELECT doc_id, size, hex(text) AS h FROM d),
c AS (SELECT doc_id, size, xor(4294967295::UBIGINT, list_reduce(
          list_prepend(4294967295::UBIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
          lambda a, v: xor(a >> 8, tab[(xor(a, v) & 255)::BIGINT + 1])))::BIGINT AS text_crc32
      FROM b, crc),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
             sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(7, (start + size // 2) // greatest(1, (total + 7) // 8))::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s
"""


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract_main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    out = chat_format.format_chats(turns.unionByName(extra))
    read = out.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
                      chat_format.read_loss(F.col("segments")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escape(column: str) -> str:
    for entity in ("&amp;", "&lt;", "&lsqb;", "&NewLine;"):
        column = f"replace({column}, '{entity}', '&amp;{entity[1:]}')"
    for control in ("<|im_start|>", "<|im_next|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>"):
        column = f"replace({column}, '{control}', '&lt;{control[1:]}')"
    for control in ("[INST]", "[/INST]"):
        column = f"replace({column}, '{control}', '&lsqb;{control[1:]}')"
    return column


OP5 = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length({_sql_escape('text')}) + CASE
          WHEN before = role THEN 11
          ELSE 12 + length(replace({_sql_escape('role')}, chr(10), '&NewLine;')) + 1 + 11 END AS chars FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

NOT_HELD_OUT = "crc32(cast(cast({0} as string) as binary)) % {1} <> 0"


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = F.expr(NOT_HELD_OUT.format("doc_id", 5))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn)
    out = quality.score_quality(docs, model)
    return out.select("doc_id", F.coalesce(~learn, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lm_score.score_texts(docs, F.expr(NOT_HELD_OUT.format("doc_id", 10)))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT item_id, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i, ws FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS w FROM bw),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i, ws FROM d, sizes WHERE len(ws) >= k),
hits AS (SELECT doc_id, i, win.k, item_id FROM dw JOIN win ON win.k = dw.k AND win.w = array_to_string(list_slice(ws, i, i + dw.k - 1), ' ')),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP10 = """
WITH v AS (SELECT DISTINCT vec_id, len(embedding) AS dim, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND q.dim = c.dim),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=5, percent=80)


OP12 = rf"""
WITH RECURSIVE c AS (SELECT text, row_number() OVER (ORDER BY text) AS cid FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
w AS (SELECT cid, regexp_extract_all({_LOWER}, '[^ 	-
]+') AS ws FROM c),
s AS (SELECT DISTINCT cid, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS g
      FROM (SELECT cid, ws, least(5, len(ws)) AS k, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT cid, count(*) AS n FROM s GROUP BY cid),
o AS (SELECT a.cid AS a, b.cid AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.cid < b.cid GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.cid = a JOIN n y ON y.cid = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
arcs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(cid, r) AS (SELECT cid, cid FROM c UNION SELECT reach.cid, arcs.b FROM reach JOIN arcs ON arcs.a = reach.r),
least_id AS (SELECT reach.cid, min(doc_id) AS component_id FROM reach JOIN c ON c.cid = reach.r
             JOIN documents d ON coalesce(d.text, '') = c.text GROUP BY reach.cid)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n IS NULL THEN d.doc_id ELSE l.component_id END AS component_id
FROM documents d JOIN c ON c.text = coalesce(d.text, '') LEFT JOIN n ON n.cid = c.cid LEFT JOIN least_id l ON l.cid = c.cid
"""


def op13_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"))


OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM k GROUP BY lang),
gc AS (SELECT t.lang, source, t.term, count(*) AS c FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
gn AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM gc GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(gc.c, 0) + 5)) // (coalesce(gn.n, 0) + 5 * l.v) AS p,
             1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN gn USING (lang, source)
      LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source AND gc.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_sharding, op3_html_extraction, op4_simhash_near_dedup, op5_chat_formatting, op6_quality_classifier,
    op7_lm_scoring, op8_benchmark_decontamination, op9_packing, op10_topk_search, op11_embedding_whitening, op12_ngram_jaccard_join,
    op13_source_divergence_audit)}
ORACLE = {"op1_line_dedup": OP1, "op2_sharding": OP2, "op5_chat_formatting": OP5, "op8_benchmark_decontamination": OP8,
          "op10_topk_search": OP10, "op12_ngram_jaccard_join": OP12, "op13_source_divergence_audit": OP13}
