"""The corpus operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from kinbridge import workspace
from kinbridge.llm import (
    bpe,
    conversations,
    main_text,
    mixing,
    phrases,
    quality,
    rotated_codes,
    sentence_spans,
    simhash,
    token_rollup,
    topk,
    toxicity,
    warc,
)
from kinbridge.llm.common import fold, staged, table
from kinbridge.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Rank file of the production tokenizer; its version names the rollups.
TOKENIZER = "byte_bpe_multi_50k"
RANKS = public_tokenizers.path(f"{TOKENIZER}.tiktoken")
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    """Registers a query under its function name."""

    @wraps(fn)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = prepared
    return fn


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(spark, docs, table(spark, sf_dir, "labels"))
    return quality.with_score(spark, docs, model, "score").select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draws(spark, table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
    )


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op3_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, [floor(CAST(e AS DOUBLE) * 1024) FOR e IN embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
), scored AS (
  SELECT q.n AS query, q.vec_id AS query_id, p.vec_id AS vec_id,
         CAST(list_inner_product(q.x, p.x) AS BIGINT) AS score
  FROM v q JOIN v p ON p.n <> q.n AND len(p.x) = len(q.x)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; then a third is deleted and a third revised; then the
    deleted ones come back and the revised ones get their counts again."""
    docs = table(spark, sf_dir, "documents")
    rollup = token_rollup.Rollup(spark, workspace.new_folder(spark, "rollup"))
    tokens = token_rollup.token_count(spark, RANKS, public_tokenizers.PATTERN)
    counted = staged(spark, token_rollup.inserts(docs, tokens, TOKENIZER), "token-counts")
    rollup.apply("documents", counted)
    rollup.apply("documents", counted)  # delivered again, without effect
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    change = F.when(third == 0, "delete").otherwise("revise")
    touched = counted.where(third < 2).withColumn("change", change)
    rollup.apply("changes/1", touched.withColumn("tokens", F.col("tokens") * 2 + 1))
    back = F.when(third == 0, "insert").otherwise("revise")
    rollup.apply("changes/2", touched.withColumn("change", back))
    return rollup.totals()


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.with_component(spark, table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rotated_codes.near_duplicates(spark, table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL["op6_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(e AS DOUBLE) FOR e IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
    AND len([e FOR e IN embedding IF e <> 0]) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach(start, node) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.start, l.v FROM reach r JOIN links l ON l.u = r.node
), component AS (
  SELECT start AS vec_id, min(node) AS component_id FROM reach GROUP BY start
), counted AS (
  SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links,
       coalesce(m.component_id, e.vec_id) AS component_id,
       coalesce(m.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c USING (vec_id) LEFT JOIN component m USING (vec_id)
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(spark, docs, model, "score").select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.with_tokens(spark, docs, RANKS, public_tokenizers.PATTERN, "coded", ids=False)
    return coded.select("doc_id", "coded.*")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


ORACLE_SQL["op9_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.removed(docs, "removed")


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_phrases"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF w <> ''] AS ws
  FROM pieces
), languages AS (
  SELECT lang, sum(len(ws)) AS n FROM worded GROUP BY lang
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded WHERE len(ws) > 0
), found AS (
  SELECT lang, ws[i : i + k - 1] AS ws, k
  FROM starts CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)
), f AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, k, count(*) AS f
  FROM found GROUP BY lang, phrase, k HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, ws, k, f, unnest(range(1, k)) AS cut FROM f WHERE k > 1
), parted AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(ws[1 : cut], ' ') AS head,
         array_to_string(ws[cut + 1 : k], ' ') AS tail
  FROM cuts
), scored AS (
  SELECT p.lang, p.phrase, p.a, p.cut, h.f AS l, t.f AS r, n.n,
         (1000 * CAST(p.a AS HUGEINT) * CAST(n.n AS HUGEINT))
           // (CAST(h.f AS HUGEINT) * CAST(t.f AS HUGEINT)) AS score
  FROM parted p
  JOIN f h ON h.lang = p.lang AND h.phrase = p.head
  JOIN f t ON t.lang = p.lang AND t.phrase = p.tail
  JOIN languages n ON n.lang = p.lang
), best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(ws[s : s + len_in - 1], ' ') AS phrase, f
  FROM (SELECT lang, ws, k, f, unnest(range(2, k)) AS len_in FROM f WHERE k > 2)
  CROSS JOIN (SELECT unnest(range(1, 5)) AS s) WHERE s + len_in - 1 <= k
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(spark, table(spark, sf_dir, "conversations"))


@query
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.with_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
