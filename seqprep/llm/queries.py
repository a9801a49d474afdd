"""Registered queries of the training-data operators, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seqprep.llm import (
    bloom_lm,
    bpe,
    collocations,
    epsilon_join,
    html_template,
    language_id,
    mixing,
    ngram_join,
    ptolemaic,
    quality,
    topk,
    url_filter,
    warc,
)
from seqprep.sources.package import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(identity: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit(""))) % divisor


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = language_id.train(docs, keep=~held_out)
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), *language_id.columns())


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_main_text(_table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs, path, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsilon_join.embedding_links(_table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 5) == 0
    machine = quality.train(docs, _table(spark, sf_dir, "labels"), keep=~held_out)
    scored = quality.score(docs, machine)
    good = (F.col("quality_score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), good.alias("predicted"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return warc.read_archives(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("copies")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    model, shards = bloom_lm.train(docs.filter(~held_out))
    return bloom_lm.score(docs, model, shards).withColumn("held_out", held_out)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs that a rule decides are the labelled ones; the trees judge the others."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = url_filter.with_rules(pages).filter("ruled IS NOT NULL")
    model = url_filter.train(ruled.withColumn("label", (F.col("ruled") == url_filter.BLOCK).cast("int")))
    judged = url_filter.judge(pages, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("score").alias("block_score"))


def op13_ptolemaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ptolemaic.cluster_vectors(_table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_main_text": op2_main_text,
    "op3_bpe": op3_bpe,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_topk": op7_topk,
    "op8_mixing": op8_mixing,
    "op9_ngram_join": op9_ngram_join,
    "op10_lm_score": op10_lm_score,
    "op11_collocations": op11_collocations,
    "op12_url_filter": op12_url_filter,
    "op13_ptolemaic": op13_ptolemaic,
}


def _cluster_rounds(rounds: int) -> str:
    """The assignments a0, a1, ... and centroids c1, c2, ... of all rounds, as common table expressions."""
    assign = """
        a{i} AS MATERIALIZED (
            SELECT r, vec_id, x, min({{'d': d, 'c': c}}) AS best
            FROM (SELECT v.*, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.x, c{i}.x)]) AS d FROM v, c{i})
            GROUP BY r, vec_id, x
        )"""
    move = """
        c{n} AS MATERIALIZED (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS x
            FROM (SELECT best.c AS c, p, sum(x[p]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS places(p) GROUP BY ALL)
            GROUP BY c
            UNION ALL
            SELECT c, x FROM c{i} WHERE c NOT IN (SELECT best.c FROM a{i})
        )"""
    steps = [assign.format(i=0)]
    for i in range(rounds):
        steps += [move.format(i=i, n=i + 1), assign.format(i=i + 1)]
    return ",".join(steps)


ORACLES: dict[str, str] = {
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
              AND len([e FOR e IN embedding IF e <> 0]) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
            ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
        ), reach AS (
            SELECT vec_id AS u, vec_id AS v FROM embeddings
            UNION
            SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
        ), c AS (
            SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
        ), n AS (
            SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u
        )
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM c LEFT JOIN n USING (vec_id)
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(e AS DOUBLE)) FOR e IN embedding] AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
        ), d AS (
            SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p
        ), f AS (
            SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)
    """,
    "op8_mixing": r"""
        WITH n AS (
            SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS h,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST)) - 1) % 3 + 1] AS w,
                   row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS place
            FROM n GROUP BY source
        ), r AS (
            SELECT *, 2 * source_size AS cap,
                   (sum(source_size) OVER () * 3 / 2.0::DOUBLE
                    - coalesce(sum(2 * source_size) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS worth
            FROM s
            WINDOW o AS (ORDER BY 2 * source_size / w::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), t AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, coalesce((SELECT max(worth) FROM r WHERE worth * w < cap) * w, cap::DOUBLE)) AS target
            FROM r
        ), c AS (
            SELECT *, least(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END, 2) AS copies FROM t
        ), b AS (
            SELECT n.source, n.h, sum(size) AS words,
                   coalesce(sum(sum(size)) OVER (PARTITION BY n.source ORDER BY h
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM n GROUP BY n.source, n.h
        ), edge AS (
            SELECT b.source, min(h) AS h FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source
            WHERE before + words > target - copies * source_size GROUP BY b.source
        ), cut AS (
            SELECT edge.source, edge.h,
                   (target - copies * source_size - before) * 2 >= words AS last
            FROM edge JOIN b ON b.source IS NOT DISTINCT FROM edge.source AND b.h = edge.h
                      JOIN c ON c.source IS NOT DISTINCT FROM edge.source
        )
        SELECT doc_id, size, n.source, source_size, target,
               CAST(size * least(copies + CASE WHEN n.h < cut.h OR (n.h = cut.h AND cut.last) THEN 1 ELSE 0 END, 2)
                    AS BIGINT) AS taken
        FROM n JOIN c ON n.source IS NOT DISTINCT FROM c.source
               LEFT JOIN cut ON n.source IS NOT DISTINCT FROM cut.source
    """,
    "op11_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), p AS (
            SELECT row_number() OVER () AS piece, lang, regexp_extract_all(text, '[^\x20\x09]+') AS words
            FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS text FROM t)
        ), o AS MATERIALIZED (
            SELECT piece, lang, unnest(words) AS one, generate_subscripts(words, 1) AS i FROM p
        ), g AS (
            SELECT lang, one, lead(one, 1) OVER w AS two, lead(one, 2) OVER w AS three FROM o
            WINDOW w AS (PARTITION BY piece ORDER BY i)
        ), f AS MATERIALIZED (
            SELECT lang, 1 AS size, one AS phrase, count(*) AS a FROM g GROUP BY ALL
            UNION ALL
            SELECT lang, 2, one || ' ' || two, count(*) FROM g WHERE two IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
            UNION ALL
            SELECT lang, 3, one || ' ' || two || ' ' || three, count(*) FROM g WHERE three IS NOT NULL
            GROUP BY ALL HAVING count(*) >= 10
        ), inner_pairs AS (
            SELECT lang, unnest([split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2),
                                 split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3)]) AS phrase, a
            FROM f WHERE size = 3
        ), covered AS (
            SELECT lang, phrase, max(a) AS most FROM inner_pairs GROUP BY ALL
        ), c AS (
            SELECT f.* FROM f LEFT JOIN covered USING (lang, phrase)
            WHERE size > 1 AND coalesce(100 * most < 50 * a, true)
        ), k AS (
            SELECT *, 1 AS k, split_part(phrase, ' ', 1) AS head, phrase[len(split_part(phrase, ' ', 1)) + 2:] AS tail FROM c
            UNION ALL
            SELECT *, 2, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2), split_part(phrase, ' ', 3)
            FROM c WHERE size = 3
        ), s AS (
            SELECT k.lang, k.phrase, k.a, x.a AS l, y.a AS r, k,
                   CAST(1000000::HUGEINT * k.a * k.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM k JOIN f x ON x.lang || ' ' || x.phrase = k.lang || ' ' || head
                   JOIN f y ON y.lang || ' ' || y.phrase = k.lang || ' ' || tail
        ), b AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM s
        ), n AS (
            SELECT lang, count(*) AS n FROM o GROUP BY lang
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE cut = 1
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
    "op13_ptolemaic": f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c, x
            FROM v QUALIFY c < 40
        ), {_cluster_rounds(ptolemaic.ROUNDS)}
        SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{ptolemaic.ROUNDS} JOIN c{ptolemaic.ROUNDS} c ON c.c = best.c
    """,
}
