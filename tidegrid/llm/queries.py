"""The operators as registered queries over the driver tables, with their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import (
    alignment,
    chat,
    decontamination,
    filter_audit,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    repeats,
    sharding,
    token_counts,
    token_files,
    topk,
)
from tidegrid.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def shard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    placed = sharding.shard_rows(sized, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    )
    mixed = mixing.mix_sources(docs, ["doc_id", "text_hash"], inclusion=mixing.by_length(F.col("size")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chats(table(spark, sf_dir, "conversations"))


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.read_vocabulary())


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", line_dedup.host_of(F.col("url")).alias("site"), line_dedup.html_lines(F.col("html")).alias("lines")
    )
    cleaned = line_dedup.drop_site_lines(pages, F.col("site"), "lines")
    return cleaned.select(
        "page_id", "host", "n_lines", F.size("kept_lines").cast("long").alias("n_kept"),
        F.md5(F.array_join("kept_lines", "\n")).alias("kept_md5"),
    )


#: The same steps; the patterns are those of ``line_dedup.html_lines`` and ``host_of``.
LINE_DEDUP_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    coalesce(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'),
      '(?i)</?(p|div|li|ul|ol|nav|br|h[1-6]|tr|td|th|table|article|section|header|footer|title|head|body)[^a-z0-9>]*[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g') AS plain
  FROM pages),
l AS (
  SELECT r, page_id, host, [x for x in [regexp_replace(y, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')
      for y in coalesce(string_split(plain, chr(10)), [])] if x <> ''] AS lines
  FROM p),
h AS (SELECT host, count(*) AS n FROM l GROUP BY host),
c AS (
  SELECT host, line, count(*) AS n FROM (SELECT DISTINCT r, host, unnest(lines) AS line FROM l)
  GROUP BY host, line),
b AS (
  SELECT c.host, list(line) AS dropped FROM c JOIN h USING (host)
  WHERE c.n >= 2 AND c.n > 0.3 * h.n GROUP BY c.host)
SELECT page_id, l.host AS host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(kept) AS BIGINT) AS n_kept,
  md5(array_to_string(kept, chr(10))) AS kept_md5
FROM (SELECT l.*, CASE WHEN dropped IS NULL THEN lines
        ELSE [x for x in lines if NOT list_contains(dropped, x)] END AS kept
      FROM l LEFT JOIN b USING (host)) l
"""


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_dir(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, path, end_id=2)
    read = token_files.read_tokens(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    left = alignment.Side("byte_level", public_tokenizers.path("byte_bpe_50k.json"))
    right = alignment.Side("pieces", public_tokenizers.path("piece_bpe_32k.model"))
    aligned = alignment.align(table(spark, sf_dir, "documents"), left, right, digest=True)
    return aligned.documents().withColumnRenamed("groups", "groups_sha256")


def filter_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


FILTER_AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS ws
  FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
      regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN l USING (doc_id)),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, fails),
f(letter, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
o AS (
  SELECT concat(a.letter, b.letter, c.letter, d.letter, e.letter) AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS filters
  FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (
  SELECT filter_order, step, filters[step] AS own, [x for x in filters if list_position(filters, x) < step] AS earlier
  FROM o, generate_series(1, 5) AS g(step)),
j AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS bad,
    len([x for x in earlier if fails[x]]) = 0 AS here, len([x for x in fails if x]) AS failed
  FROM c, s),
r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN here AND NOT bad THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND bad THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bad AND NOT here THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bad AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND bad THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND bad THEN toxic ELSE 0 END) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""


QUERIES = {
    "op1_repeats": repeats_query,
    "op2_chat": chat_query,
    "op3_decontamination": decontamination_query,
    "op4_sharding": shard_query,
    "op5_mixing": mixing_query,
    "op6_token_counts": token_query,
    "op7_quality": quality_query,
    "op8_near_dedup": near_dedup_query,
    "op9_line_dedup": line_dedup_query,
    "op10_topk": topk_query,
    "op11_token_files": token_files_query,
    "op12_alignment": alignment_query,
    "op13_filter_audit": filter_audit_query,
}

ORACLES: dict[str, str] = {
    "op9_line_dedup": LINE_DEDUP_SQL,
    "op10_topk": TOPK_SQL,
    "op13_filter_audit": FILTER_AUDIT_SQL,
}
