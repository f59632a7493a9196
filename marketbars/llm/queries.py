"""The registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketbars.llm import (
    exact_dedup,
    html_extract,
    license_scan,
    minhash_dedup,
    mixing,
    packing,
    quality,
    sharding,
    simhash_dedup,
    spelling,
    token_alignment,
    topk_search,
    toxicity,
)
from marketbars.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, labels)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.notices(spark))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


REGISTERED = (
    op1_html_extraction,
    op2_exact_dedup,
    op3_quality,
    op4_simhash_near_dedup,
    op5_exact_top_k,
    op6_mixing,
    op7_toxicity,
    op8_license_scan,
    op9_best_fit_packing,
    op10_sharding,
    op11_minhash_near_dedup,
    op12_token_alignment,
    op13_spelling_variants,
)
QUERIES = {query.__name__: query for query in REGISTERED}

UPPER, LOWER = spelling.UPPER, spelling.LOWER

ORACLES = {
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha AS text_sha256
        FROM t WINDOW g AS (PARTITION BY sha)
    """,
    "op5_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, vec_id, score, CAST(row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM s QUALIFY rank <= 5
    """,
    "op11_minhash_near_dedup": rf"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
                lambda i: array_to_string(w[i:i + 4], ' '))) AS s
            FROM split WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b USING (s)
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach(doc_id, low) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(low) AS component_id,
               doc_id = min(low) AS kept
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op13_spelling_variants": f"""
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, step:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
            FROM range(256) r(i)),
        runs AS (
            SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
                  FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        spelt AS (
            SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
            FROM runs),
        checked AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
                range(0, length(h), 2), lambda i: CAST('0x' || substr(h, i + 1, 2) AS BIGINT))),
                lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS crc
            FROM spelt, crc_table),
        vocab AS (
            SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run))
                     || substr(run, crc % length(run) + 2) ELSE run END AS word,
                   CAST(sum(n) AS BIGINT) AS n
            FROM checked GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
        cuts AS (
            SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT *, unnest(range(length(word))) AS i FROM vocab)),
        near AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b
            ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocab b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocab b ON a.rest = b.word),
        nearest AS (
            SELECT word, count(*) AS n_near, arg_min(near, {{'n': -near_n, 'w': near}}) AS form,
                   max(near_n) AS form_n
            FROM near GROUP BY word),
        forms AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN form_n >= 5 * n THEN form END AS form,
                   CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
            FROM vocab v LEFT JOIN nearest USING (word)),
        chain(word, root) AS (
            SELECT word, form FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root
            WHERE f.form IS NOT NULL),
        ends AS (
            SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root
            WHERE f.form IS NULL)
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
        FROM forms LEFT JOIN ends USING (word)
    """,
}
