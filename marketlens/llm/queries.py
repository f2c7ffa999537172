"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.llm.divergence import audit_sources
from marketlens.llm.hardnegatives import mine_hard_negatives
from marketlens.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, block_step, find_licenses, split
from marketlens.llm.linededup import drop_repeated_lines
from marketlens.llm.mixing import mix_sources
from marketlens.llm.packing import pack_documents
from marketlens.llm.pivots import embedding_groups
from marketlens.llm.secret_scan import BASE_KINDS, find_secrets
from marketlens.llm.shared import Shared, ship
from marketlens.llm.simhash import simhash_groups
from marketlens.llm.toolcalls import link_tool_calls
from marketlens.llm.topk import top_inner_products
from marketlens.llm.toxicity import held_out, score_toxicity, train
from marketlens.llm.warc import read_archives, write_archives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_inner_products(vectors, F.col("vec_id") % 20 == 0, k=20)


def digest(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def number_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [number_of(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", "fingerprint", "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = Shared(spark)
    archives = shared.put(write_archives(table(spark, sf_dir, "pages"), shared.path()))
    return read_archives(spark, archives, keep_payload=False).drop("payload")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "spans")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


#: What the calls of a conversation may hold.
CALL_SCHEMAS = {
    "configure": {
        "type": "object", "required": ["text"], "additionalProperties": False,
        "properties": {
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0, "maximum": 0},
        },
    },
    "reply": {
        "type": "object", "required": ["text", "turn"], "additionalProperties": False,
        "properties": {
            "text": {"type": "string", "minLength": 20}, "turn": {"type": "integer", "minimum": 0},
        },
    },
}


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System and user turns are calls; any other turn is the result of the turn before it,
    and a call depends on the call two turns earlier."""
    turns = table(spark, sf_dir, "conversations")
    asks = F.coalesce(F.col("role").isin("system", "user"), F.lit(False))
    call = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    calls = turns.filter(asks).select(
        F.col("conv_id").alias("conv"), call(F.col("turn")).alias("call"),
        F.col("turn").alias("seq"),
        F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call(F.col("turn") - 2)))
        .otherwise(F.array().cast("array<string>")).alias("after"),
    )
    results = turns.filter(~asks).select(
        F.col("conv_id").alias("conv"), call(F.col("turn") - 1).alias("call"),
        F.col("turn").alias("seq"), F.col("text").alias("content"),
    )
    return link_tool_calls(calls, results, CALL_SCHEMAS)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents")).drop("blocks")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

OP4_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31)
                  ::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""

OP9_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), common AS (
  SELECT key, max(doc_id) AS last FROM keyed
  WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r
"""

OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: x::DOUBLE) AS v
  FROM embeddings
), fine AS (
  SELECT * FROM v WHERE label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id FROM fine a
  JOIN fine b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT r AS a, r AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id
  FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a
), degree AS (
  SELECT a AS r, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(degree.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component USING (r) LEFT JOIN degree USING (r)
"""

#: Terms of every row, in lower case; ``words`` is also what the license scan cuts texts into.
WORDS_SQL = r"""
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-%s\x5B-\x60\x7B-\x7F]+')
"""

OP11_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {WORDS_SQL % r"@"} AS words
  FROM documents
), terms AS (
  SELECT r, lang, source, unnest(words) AS term FROM docs
), vocabulary AS (
  SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM terms JOIN vocabulary USING (lang, term)
  GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang
), of_source AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), of_lang AS (
  SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total
  FROM counts GROUP BY lang, term
), p AS (
  SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT)
             // (coalesce(t.total, 0) + 5 * s.v)::HUGEINT AS p
  FROM groups g JOIN vocabulary w USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term
  LEFT JOIN of_source t ON t.lang = g.lang AND t.source = g.source
), q AS (
  SELECT lang, term,
         1 + (1000000000 * (n + 5)::HUGEINT) // (total + 5 * v)::HUGEINT AS q
  FROM of_lang JOIN sizes USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL
  GROUP BY a.lang, a.source, b.source
), above AS (
  SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM above
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 50
"""


def text_list(words: list[bytes]) -> str:
    return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"


def op12_sql() -> str:
    """Base places and, for every length of block, all blocks against all templates."""
    places = " || ".join(
        f"list_filter(places, lambda p: words[p + 1:p + {len(split(text))}] = "
        f"{text_list(split(text))})" for text, _ in PHRASES
    )
    named = " || ".join(
        f"CASE WHEN len(list_filter(places, lambda p: words[p + 1:p + {len(split(text))}] = "
        f"{text_list(split(text))})) > 0 THEN ['{label}'] ELSE CAST([] AS VARCHAR[]) END"
        for text, label in PHRASES
    )
    templates = ", ".join(
        f"('{label}', {block_step(len(split(text)))}, {text_list(sorted(set(split(text))))})"
        for label, text in TEMPLATES
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL % r"/:-@"} AS words FROM documents
), placed AS (
  SELECT *, range(len(words)) AS places FROM docs
), base AS (
  SELECT r, doc_id, words, {places} AS places, {named} AS base FROM placed
), templates(label, step, tokens) AS (
  VALUES {templates}
), blocks AS (
  SELECT r, step, list_distinct(words[start + 1:start + 2 * step]) AS block
  FROM (SELECT r, words, step, unnest(range(0, len(words), step)) AS start
        FROM docs, (SELECT DISTINCT step FROM templates))
), found AS (
  SELECT r, label, len(list_intersect(block, tokens)) / len(tokens) AS share
  FROM blocks JOIN templates USING (step)
), best AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS score FROM found
  WHERE share >= {CONTAINMENT} GROUP BY r
)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base, list_min(places) AS first_word,
       list_max(places) AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(labels, CAST([] AS VARCHAR[])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
FROM base LEFT JOIN best USING (r)
"""


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT r, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
), windows AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY r, place ORDER BY score DESC, vec_id) AS n
  FROM positives JOIN scored USING (r)
  WHERE place <= 5 AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM windows WHERE n <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_secrets": op2_secrets,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_tool_calls": op8_tool_calls,
    "op9_line_dedup": op9_line_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_divergence": op11_divergence,
    "op12_licenses": op12_licenses,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_topk": OP1_SQL, "op4_warc": OP4_SQL, "op9_line_dedup": OP9_SQL,
    "op10_embedding_dedup": OP10_SQL, "op11_divergence": OP11_SQL, "op12_licenses": op12_sql(),
    "op13_hard_negatives": OP13_SQL,
}
