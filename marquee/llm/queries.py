"""The registered queries of the package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    byte_bpe,
    cap_dedup,
    cover_topk,
    fim,
    html_extract,
    jaccard_join,
    packing,
    pii,
    spelling,
    token_counts,
    toxicity,
    url_rules,
    warc,
)
from marquee.llm.texts import table
from marquee.session import materialise


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), path)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.score(docs, net).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), min_length=5, min_count=3, every=97)
    return spelling.variant_groups(words, ratio=2).select("word", "form", "root", "n", "n_near", "form_n")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages are archived, then every url is looked up in the index and its records are read back."""
    pages = table(spark, sf_dir, "pages")
    folder, captures = warc.write_archives(pages)
    index = warc.build_index(captures)
    found = materialise(warc.look_up(index, pages.select("url")), "warc-found")
    records = warc.read_records(folder, found, payload=False)
    return records.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_url_filter": op7_url_filter,
    "op8_personal_data": op8_personal_data,
    "op9_toxicity": op9_toxicity,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_warc": op13_warc,
}

_FINITE = "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"

ORACLE: dict[str, str] = {
    "op2_exact_top_k": f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND {_FINITE}
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
        )
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
    """,
    "op10_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND {_FINITE} AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.x, b.x) >= 0.93
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
        ), component AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, root AS component_id, e.vec_id = root AS kept
        FROM embeddings e JOIN component c ON c.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
    """,
    "op6_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
            FROM w
        ), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        link AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
        )
        SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.root AS component_id
        FROM s JOIN (SELECT a, min(b) AS root FROM reach GROUP BY a) c ON c.a = s.doc_id
    """,
    "op7_url_filter": """
        WITH u AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), h AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), r(rule_host, rule_path, action) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), fit AS (
            SELECT page_id, rule_host || rule_path AS rule, action,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM h JOIN r ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT h.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
        FROM h LEFT JOIN fit ON h.page_id = fit.page_id AND place = 1
    """,
    "op11_fill_in_middle": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
        d AS (
            SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM t
        ), f AS (
            SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        ), p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p
    """,
    "op12_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS crc
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ), counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS raw FROM runs GROUP BY ALL),
        hashed AS (
            SELECT run, n, xor(list_reduce(list_transform(range(len(raw) // 2), lambda i: CAST('0x' || raw[2 * i + 1 : 2 * i + 2] AS BIGINT)),
                lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
            FROM counted, crc_table
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), cut AS (
            SELECT word, n, i, word[1 : i - 1] AS b, word[i + 1 :] AS e FROM words, unnest(range(1, length(word) + 1)) AS u(i)
        ), pairs AS (
            SELECT x.word AS a, y.word AS w FROM cut x JOIN cut y ON x.b = y.b AND x.e = y.e AND x.word <> y.word
            UNION SELECT x.word, w.word FROM cut x JOIN words w ON x.b || x.e = w.word
            UNION SELECT w.word, x.word FROM cut x JOIN words w ON x.b || x.e = w.word
        ), near AS (
            SELECT a AS word, count(*) AS n_near, arg_min(struct_pack(w := w, n := n), struct_pack(less := -n, w := encode(w))) AS best
            FROM pairs JOIN words ON words.word = w GROUP BY a
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * n THEN best.w END AS form, CASE WHEN best.n >= 2 * n THEN best.n END AS form_n
            FROM words LEFT JOIN near USING (word)
        ), chain AS (
            SELECT word, word AS tip, 0 AS step FROM formed
            UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.tip WHERE f.form IS NOT NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(tip, step) AS root FROM chain GROUP BY word) USING (word)
    """,
    "op13_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
        ), k AS (SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest, n)
        SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM keeper AND keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
        FROM p LEFT JOIN k ON p.digest = k.digest AND p.n = k.n
    """,
}
