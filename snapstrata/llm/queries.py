"""One registered query per operator over its whole table, and SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import (
    conversation_repair,
    decontamination,
    embedding_dedup,
    host_reputation,
    license_scan,
    merkle_manifest,
    ngram_lm,
    piece_lattice,
    simhash_dedup,
    token_files,
    warc,
    window_dedup,
    zstd_language,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"
N_BEST = 4


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def hex16(value: str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@register
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
        F.coalesce(F.get("matches", F.lit(0))["n_words"], F.lit(0).cast("long")).alias("longest_match"),
    )


@register
def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_lattice.PieceModel.load(public_tokenizers.path(PIECE_MODEL))
    return piece_lattice.encode_summary(table(spark, sf_dir, "documents"), model, n_best=N_BEST, keep=["doc_id"])


@register
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)
    return groups.select("doc_id", hex16("fingerprint").alias("fingerprint"), "component_id")


def language_model(spark: SparkSession, sf_dir: str) -> zstd_language.LanguageModel:
    """Learned from the text and language of the documents outside the held-out fold."""
    return zstd_language.learn(table(spark, sf_dir, "documents").where(fold() != 0))


@register
def op10_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold() == 0, F.lit(False))
    judged = zstd_language.identify(docs.select("doc_id", "text"), language_model(spark, sf_dir), keep=["doc_id"])
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_rejected")


URL_RULES = [
    host_reputation.UrlRule("net", "/", "block"),
    host_reputation.UrlRule("example.net", "/en/", "allow"),
    host_reputation.UrlRule("example.com", "/de/", "block"),
    host_reputation.UrlRule("org", "/fr/", "allow"),
]


@register
def op9_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the number that ends a page's path is the document it shows
    _, path = host_reputation.url_parts(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html|/)?\z", 1)
    return host_reputation.judge_urls(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES,
        document_of=F.nullif(number, F.lit("")).cast("long"),
    )


def _strength_sql(children: str) -> str:
    return f"""(SELECT 1 / greatest(0.001, least(0.5, coalesce(
      sum(CASE WHEN n > 0 THEN n * pow(k / n - m, 2) - m * (1 - m) END)
        / nullif(sum(CASE WHEN n > 0 THEN m * (1 - m) * (n - 1) END), 0), 0.001))) - 1 FROM {children})"""


SQL["op9_host_reputation"] = (
    r"""
WITH cut AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path
  FROM cut),
parts AS (
  SELECT *, CAST(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.html|/)?\z', 1), '') AS BIGINT) AS document FROM split),
known AS (
  SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(CAST(bad AS BIGINT)), 0) AS k,
         regexp_extract(host, '(^|\.)([^.]+\.(?:ac\.uk|co\.jp|co\.uk|com\.au|com\.br)|[^.]+\.[^.]*|[^.]*)\z', 2) AS domain,
         regexp_extract(host, '(^|\.)(ac\.uk|co\.jp|co\.uk|com\.au|com\.br|[^.]*)\z', 2) AS suffix
  FROM parts LEFT JOIN known ON document = doc_id GROUP BY host),
named AS (SELECT * FROM hosts WHERE host <> ''),
every AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT m FROM every) AS m FROM named GROUP BY suffix),
s1 AS (SELECT suffix, (k + s * m) / (n + s) AS m FROM (SELECT *, """
    + _strength_sql("s0")
    + r""" AS s FROM s0)),
d0 AS (SELECT domain, any_value(s1.m) AS m, sum(n) AS n, sum(k) AS k FROM named JOIN s1 USING (suffix) GROUP BY domain),
d1 AS (SELECT domain, (k + s * m) / (n + s) AS m FROM (SELECT *, """
    + _strength_sql("d0")
    + r""" AS s FROM d0)),
h0 AS (SELECT host, n, k, d1.m AS m FROM named JOIN d1 USING (domain)),
h1 AS (
  SELECT host, k + s * m AS a, n - k + s * (1 - m) AS b FROM (SELECT *, """
    + _strength_sql("h0")
    + r""" AS s FROM h0)
  UNION ALL SELECT '', coalesce(sum(k), 0) + 1, coalesce(sum(n), 0) - coalesce(sum(k), 0) + 1 FROM hosts),
judged AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 AS bad_host FROM h1),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN bad_host THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN judged USING (host)
"""
)


TOKENIZER, END_ID, VOCABULARY = "word_bpe_49k.json", 1, 49_408


@register
def op2_token_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)
    return token_files.read_token_files(spark, written, VOCABULARY)


@register
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


SQL["op4_embedding_near_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
reach AS (SELECT a AS root, b AS node FROM links UNION SELECT reach.root, links.b FROM reach JOIN links ON reach.node = links.a),
least AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(root, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(root, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON vec_id = a LEFT JOIN least ON vec_id = node
"""


@register
def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)


SQL["op8_warc_normaliser"] = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS INTEGER)
                 >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest
  FROM hashed),
first AS (SELECT payload_digest, min(page_id) AS first_id FROM named GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named JOIN first USING (payload_digest)
"""


@register
def op7_ngram_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_lm.train(docs.where(fold() != 1))
    scored = ngram_lm.score_texts(docs, model, keep=["doc_id"])
    return scored.withColumn("held_out", F.coalesce(fold() == 1, F.lit(False)))


@register
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan_licenses(docs, license_scan.learn(docs), keep=["doc_id"])
    families = F.filter(F.col("findings.family"), lambda x: x != license_scan.UNKNOWN)
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.array_sort(F.array_distinct(families)).alias("licenses"),
        F.size(F.filter("findings", lambda x: x["family"] == license_scan.UNKNOWN)).cast("long").alias("n_unknown"),
        F.array_max(F.col("findings.probability")).alias("probability"),
    )


@register
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = window_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"), window=13, keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op11_substring_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') AS parts FROM documents),
words AS (
  SELECT r, doc_id, i, word FROM (
    SELECT r, doc_id, unnest(range(1, len(list_filter(parts, lambda x: x <> '')) + 1)) AS i,
           unnest(list_filter(parts, lambda x: x <> '')) AS word FROM docs)),
windows AS (
  SELECT r, doc_id, i, word, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS ahead FROM words),
judged AS (
  SELECT r, doc_id, i, word, len(ahead) = 13 AND coalesce(min(doc_id) OVER (PARTITION BY ahead) < doc_id, false) AS again FROM windows),
covered AS (
  SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM judged),
folded AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM covered GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN folded USING (r)
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that their key calls for; a null counts as one blank."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, blank) for c in ("role", "text"))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .drop("col")
    )


@register
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = conversation_repair.Repair(damaged(conversations)).summary
    every = conversations.select("conv_id").distinct()
    joined = every.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle_manifest.manifest(
        table(spark, sf_dir, "documents"), FIELDS, tree="lang", id="doc_id",
        tampered={"n_chars": F.col("n_chars") + 1},
        when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
    )
    proof = F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256")
    return proved.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", "verified")


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    bits = f"""list_transform(range(0, 8 * CAST(strlen({text}) AS BIGINT)),
      lambda k: (ascii(substr({text}, CAST(k // 8 + 1 AS INTEGER), 1)) >> CAST(k % 8 AS INTEGER)) & 1)"""
    return f"""xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {bits}),
      lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))"""


def _leaf_sql(**other: str) -> str:
    parts = [f"coalesce(strlen(CAST({other.get(c, c)} AS VARCHAR)) || ':' || {other.get(c, c)}, '-')" for c in FIELDS]
    return f"sha256({' || '.join(parts)})"


SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf_sql()} AS leaf,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql(n_chars="(n_chars + 1)")} END AS other
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
low AS (
  SELECT tree, 0 AS level, place, n AS width, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (any_value(width) + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM low WHERE width > 1 GROUP BY tree, level, place // 2),
subroots AS (
  SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS trees FROM low WHERE width = 1),
high AS (
  SELECT 0 AS level, rank AS place, trees AS width, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (any_value(width) + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM high WHERE width > 1 GROUP BY level, place // 2),
heights AS (SELECT tree, max(level) AS height FROM low GROUP BY tree),
every AS (
  SELECT tree, level, place, width, node FROM low WHERE width > 1
  UNION ALL SELECT tree, height + level, place, width, high.node FROM high, heights WHERE width > 1),
walk AS (
  SELECT doc_id, leaf, placed.tree AS tree, 0 AS level, place, '' AS proof, coalesce(other, leaf) AS fold, height, rank
  FROM placed JOIN heights USING (tree) JOIN subroots USING (tree)
  UNION ALL
  SELECT doc_id, leaf, w.tree, w.level + 1, CASE WHEN w.level + 1 = height THEN rank ELSE w.place // 2 END, proof || coalesce(s.node, ''),
         sha256(CASE WHEN s.node IS NULL THEN fold WHEN w.place % 2 = 1 THEN s.node || fold ELSE fold || s.node END), height, rank
  FROM (SELECT w.*, CASE WHEN w.place % 2 = 1 THEN w.place - 1 ELSE w.place + 1 END AS other_place FROM
          (SELECT doc_id, leaf, tree, level, CASE WHEN level = height THEN rank ELSE place END AS place, proof, fold, height, rank FROM walk) w) w
  JOIN (SELECT DISTINCT tree, level FROM every) l ON l.tree = w.tree AND l.level = w.level
  LEFT JOIN every s ON s.tree = w.tree AND s.level = w.level AND s.place = w.other_place)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM walk JOIN subroots USING (tree) CROSS JOIN (SELECT node AS root, level AS top FROM high WHERE width = 1) r
WHERE walk.level = height + top
"""


_EXPECTED = "CASE WHEN state = 2 THEN 'assistant' ELSE 'user' END"
_THEN = "CASE WHEN state = 2 THEN 3 ELSE 2 END"
_MORE = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"


def _line(role: str, text: str) -> str:
    return f"CASE WHEN b.lines IS NULL THEN {role} || ':' || {text} ELSE b.lines || chr(10) || {role} || ':' || {text} END"


def _inserted(source: str, again: int) -> str:
    """The best of each state after up to so many insertions."""
    step = f"""SELECT conv, i, {_THEN} AS state,
      struct_pack(cost := b.cost + 5, audit := b.audit || 'I', lines := {_line(_EXPECTED, "''")}) AS b FROM ({source}) x"""
    out = f"SELECT conv, i, state, min(b) AS b FROM (SELECT * FROM ({source}) y UNION ALL {step}) z GROUP BY ALL"
    return out if again == 1 else _inserted(out, again - 1)


_ROW = f"""SELECT s.conv, s.i + 1 AS i, state, b FROM (
  SELECT conv, i, state, struct_pack(cost := b.cost + 2, audit := b.audit || 'D', lines := b.lines) AS b FROM s
  UNION ALL SELECT conv, i, CASE WHEN initial = 's' THEN 1 ELSE {_THEN} END,
    struct_pack(cost := b.cost + {_MORE}, audit := b.audit || 'K', lines := {_line("role", "text")}) FROM s
    WHERE fault IN ('', 't') AND (initial = left({_EXPECTED}, 1) OR (state = 0 AND initial = 's'))
  UNION ALL SELECT conv, i, {_THEN},
    struct_pack(cost := b.cost + 1 + {_MORE}, audit := b.audit || 'R', lines := {_line(_EXPECTED, "text")}) FROM s WHERE fault IN ('', 't')) s"""

SQL["op12_conversation_repair"] = f"""
WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT *, {_crc32_sql("key")} % 20 AS kind FROM keyed),
hurt AS (
  SELECT conv_id AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i,
         right(regexp_replace(text, '[\\x20\\x09-\\x0D]+$', ''), 1) AS ending, left(role, 1) AS initial
  FROM hurt),
judged AS (
  SELECT *, CASE WHEN ending = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
  FROM ordered),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv),
steps AS (
  SELECT conv, 0::BIGINT AS i, 0 AS state, struct_pack(cost := 0::BIGINT, audit := '', lines := NULL::VARCHAR) AS b FROM counts
  UNION ALL
  SELECT conv, i, state, min(b) AS b FROM (
    WITH s AS (SELECT x.*, role, text, fault, initial
               FROM ({_inserted("SELECT * FROM steps", 3)}) x JOIN judged j ON j.conv IS NOT DISTINCT FROM x.conv AND j.i = x.i)
    {_ROW}) GROUP BY conv, i, state),
ended AS (
  SELECT c.conv, min(x.b) AS b FROM ({_inserted("SELECT * FROM steps", 2)}) x JOIN counts c ON c.conv IS NOT DISTINCT FROM x.conv AND c.n = x.i
  WHERE state IN (0, 3) GROUP BY c.conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(b.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counts c ON c.conv IS NOT DISTINCT FROM conv_id LEFT JOIN ended e ON e.conv IS NOT DISTINCT FROM conv_id
"""
