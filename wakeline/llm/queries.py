"""One query for each operator of this folder, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import alignment, byte_bpe, chat, divergence, fingerprints, html_extract, ngram_join, packing, pii, quality, sharding, token_counts, topk
from wakeline.llm.common import settle, table

QUERIES = {}
CHECKS = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.ngram_join(table(spark, folder, "documents", "doc_id", "text"), words=3, part=(9, 10))


CHECKS["op1_ngram_join"] = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS t FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS s FROM tokens),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS component_id,
  (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id)
"""


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the token ids of every text and of the bytes they decode to."""
    settle(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = table(spark, folder, "documents", "doc_id", "text").select("doc_id", byte_bpe.encode(F.col("text"), *vocabulary).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), byte_bpe.ids_sha256(F.col("ids")).alias("ids_sha256"),
                      F.sha2(byte_bpe.decode(F.col("ids"), *vocabulary), 256).alias("decoded_sha256"))


@query
def op5_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents over eight equal shards, by id."""
    return sharding.shard_documents(table(spark, folder, "documents", "doc_id", "text"), 8)


def _cost_sql(shard: int) -> str:
    return f"-ln((('0x' || substr(md5(k || '/{shard}'), 1, 13))::BIGINT + 0.5) / {16 ** sharding.DIGITS}.0)"


def _shard_sql(shards: int) -> str:
    return "least(" + ", ".join(f"{{'c': {_cost_sql(s)}, 's': {s}}}" for s in range(shards)) + ").s"


CHECKS["op5_rendezvous_sharding"] = f"""
WITH codes AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS code),
bytes AS (SELECT doc_id, coalesce('k' || doc_id, 'n') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
rows AS (SELECT doc_id, k, length(h) // 2 + 1 AS size, xor(list_reduce([4294967295] || list_transform(regexp_extract_all(h, '..'),
    lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, code[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM bytes, codes),
dealt AS (SELECT *, {_shard_sql(8)} AS shard, {_shard_sql(9)} AS grown_shard,
    ('0x' || substr(md5(k || '/k' || text_crc32 || '/k' || size), 1, 8))::BIGINT % {sharding.SLOT_BUCKETS} AS bucket FROM rows)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot
FROM dealt
"""


@query
def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, and of one that holds control strings, read back from its formatted text."""
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = chat.format_chat(rows.unionByName(own)).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                      F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("bigint").alias("formatted_chars"))


CHECKS["op6_chat_formatting"] = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
shown AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was,
  length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) AS chars,
  length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), chr(10), '&nl;')) AS role_chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + CASE WHEN was = role THEN 7 ELSE 19 + role_chars - 1 END)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


@query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token pieces in sequences of 1024."""
    return packing.pack_documents(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0, k=20)


CHECKS["op9_exact_top_k"] = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0 AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how near they are."""
    return fingerprints.fingerprint_edits(table(spark, folder, "documents", "doc_id", "text"))


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


#: A document is rejected below this score.
QUALITY_CUT = 0.3


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents by a model of the labels that are not held out."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    model = quality.fit_labelled(docs, table(spark, folder, "labels", "doc_id", "quality"), "quality", ~held_out(F.col("id")))
    return quality.with_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents: base spans by pattern, and those the field adds."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = docs.select("doc_id", pii.spans(F.col("text"), pii.fit(docs)).alias("found"))
    base = F.filter("found", lambda s: s["base"])

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(table(spark, folder, "pages", "page_id", "url", "html"))


@query
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every text, and whether it has over 512 tokens."""
    settle(spark)
    text = F.col("text")
    return table(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_counts.token_count(text, public_tokenizers.path("byte_bpe_50k.json")).alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > 512)


@query
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizations of every text."""
    return alignment.align_documents(table(spark, folder, "documents", "doc_id", "text"),
                                     public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances of all sources of a language, and the terms each uses more than its language."""
    return divergence.divergence(table(spark, folder, "documents", "text", "lang", "source"))


CHECKS["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
words AS (SELECT doc_id, lang, source, unnest(t) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
langs AS (SELECT d.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept k USING (lang) GROUP BY d.lang),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(t.n, 0) AS n, v, total FROM (SELECT DISTINCT lang, source FROM docs) g
  JOIN langs USING (lang) LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 5) // (g.n + 5 * v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 5) // (total + 5 * v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
