"""One registered query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bisector, bpe, chat_format, cover_tree, language_id, line_dedup, mixing, ngram_join, pii, pivot_dedup, ppm, threshold_topk, warc
from candlewick.llm.common import bucket_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query
def op1_pivot_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups among all vectors of a label."""
    return pivot_dedup.pivot_dedup(table(spark, sf, "embeddings"))


@query
def op2_threshold_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Ten best partners of every hundredth vector."""
    return threshold_topk.top_k(table(spark, sf, "embeddings"))


ORACLES["op2_threshold_topk"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS w FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation formatted; digests of what is read back from the output."""
    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], rows.schema))
    done = chat_format.format_conversations(rows)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), F.col("rewrites").isNotNull().alias("rewrites_history"),
    )


@query
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return ngram_join.ngram_join(table(spark, sf, "documents"))


@query
def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every text and the text of the ids, as digests."""
    path = public_tokenizers.path(TOKENIZER)
    done = bpe.decode(bpe.encode(table(spark, sf, "documents"), path), path)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; every fifth one is held out of the training."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", (bucket_of(F.col("doc_id"), 5) == 0).alias("held_out"))
    net = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), net).select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix by weights 5, 2, 1 takes of each document."""
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that are fuzzy copies of earlier ones."""
    done = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return done.select("doc_id", "text", "n_lines", F.size("removed").alias("n_removed"))


@query
def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of personal data per document."""
    done = pii.find_pii(table(spark, sf, "documents"))
    base = [k.name for k in pii.BASE]
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    return done.select("doc_id", *counts, F.sha2(shown(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


@query
def op10_ppm(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of every text; every tenth document is held out of the training."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = ppm.score_texts(docs, bucket_of(F.col("doc_id"), 10) != 0)
    return done.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _digest(numbers: str) -> Column:
    return F.sha2(F.array_join(F.col(numbers).cast("array<string>"), ","), 256)


@query
def op11_bisector(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster of every vector of 64 components after ten rounds."""
    told, centroids = bisector.bisector_clusters(table(spark, sf, "embeddings"))
    shown = centroids.select("cluster", _digest("centroid").alias("centroid_sha256"))  # 8 rows
    return told.join(F.broadcast(shown), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _nearest(points: str, books: str, on: str, out: str) -> str:
    """SQL: each row of ``points`` (columns ``vec_id, part, w``) with its nearest entry of ``books`` (``part, c, m``)."""
    return f"""{out} AS MATERIALIZED (
      SELECT vec_id, part, w, c, d FROM (
        SELECT p.vec_id, p.part, p.w, b.c, list_sum(list_transform(list_zip(p.w, b.m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d,
               row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY d, b.c) AS r
        FROM {points} p JOIN {books} b ON {on}) WHERE r = 1)"""


def _lloyd(rounds: int) -> str:
    """SQL: ``rounds`` Lloyd rounds from ``books0`` over ``points``, as common table expressions; the last assignment is ``told``."""
    on = "p.part = b.part"
    steps = []
    for i in range(rounds):
        steps.append(_nearest("points", f"books{i}", on, f"near{i}"))
        steps.append(f"""books{i + 1} AS MATERIALIZED (
      SELECT b.part, b.c, coalesce(n.m, b.m) AS m FROM books{i} b LEFT JOIN (
        SELECT part, c, list(v ORDER BY pos) AS m FROM (
          SELECT part, c, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS v
          FROM (SELECT part, c, unnest(w) AS x, unnest(range(len(w))) AS pos FROM near{i}) GROUP BY part, c, pos) GROUP BY part, c) n
      ON b.part = n.part AND b.c = n.c)""")
    return ",\n".join([*steps, _nearest("points", f"books{rounds}", on, "told")])


_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES["op11_bisector"] = f"""
    WITH points AS MATERIALIZED (SELECT vec_id, 0 AS part, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS HUGEINT)) AS w
                    FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64),
    books0 AS MATERIALIZED (SELECT 0 AS part, r - 1 AS c, w AS m FROM (SELECT w, row_number() OVER (ORDER BY sha256('3:' || vec_id)) AS r FROM points) WHERE r <= 8),
    {_lloyd(10)}
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM told JOIN books10 USING (part, c)
"""


@query
def op12_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Code of every vector in eight parts of sixteen entries."""
    told, books = cover_tree.cover_tree_codes(table(spark, sf, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    shown = books.select("size", _digest("codebooks").alias("codebooks_sha256"))  # one row per vector length
    return told.join(F.broadcast(shown), "size").select("vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


ORACLES["op12_cover_tree"] = f"""
    WITH whole AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS HUGEINT)) AS w
                    FROM embeddings WHERE {_WHOLE}),
    points AS MATERIALIZED (SELECT vec_id, part, w[part * (len(w) // 8) + 1 : (part + 1) * (len(w) // 8)] AS w FROM whole, range(8) t(part)),
    books0 AS MATERIALIZED (SELECT part, r - 1 AS c, w AS m FROM (SELECT part, w, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS r FROM points) WHERE r <= 16),
    {_lloyd(6)},
    digest AS (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY part, c)) AS codebooks_sha256 FROM books6),
    coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(c AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM told GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN whole USING (vec_id), digest
"""


@query
def op13_capture_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written as a WARC record and read back through the capture index."""
    pages = table(spark, sf, "pages")
    told = warc.read_pages(warc.capture(pages), warc.lookups(pages, warc.url_key(F.col("url")), F.col("page_id")))
    return told.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op13_capture_index"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT page_id, html, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
"""
