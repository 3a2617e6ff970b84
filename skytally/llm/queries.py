"""The operators as registered queries, each over its whole table."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import multi_index, ranked, topk
from skytally.llm.alignment import token_groups, with_counts
from skytally.llm.balance import shard_documents
from skytally.llm.common import table
from skytally.llm.extraction import extract
from skytally.llm.lines import dedup_lines
from skytally.llm.packing import pack
from skytally.llm.repeats import remove_repeats
from skytally.llm.sentencepieces import decode, encode
from skytally.llm.simhash import near_groups
from skytally.llm.toxicity import Model, fit, score
from skytally.llm.url_reputation import Rule, host_and_path, judge

URL_RULES = (
    Rule(True, "com/"),
    Rule(False, "example.com/en/"),
    Rule(True, "www.example.com/en/"),
    Rule(False, "net/es/"),
    Rule(False, "net/fr/"),
)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of labelled pages. The number in a url is the document the page shows; it
    is bad if it is labelled as toxic or as of low quality."""
    host, path = host_and_path(F.col("url"))
    shown = pages.select(
        host.alias("host"), F.regexp_extract(path, r"/(\d{1,18})", 1).try_cast("long").alias("doc_id")
    )
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    bad = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(bad, F.lit(False)).cast("int")).alias("bad")
    )
    return shown.join(bad, "doc_id").select("host", "bad")


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, table(spark, folder, "labels"))
    return judge(pages, URL_RULES, outcomes).select(
        "page.page_id", "host", "path", "rule", "verdict", "level"
    )


def op2_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages").select("page_id", "url", "html")).select(
        "page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op7_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decode(encode(docs, path), path).select(
        "doc.doc_id",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def held_out(doc_id) -> Column:
    """Rows whose labels are for testing only."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def toxicity_model(spark: SparkSession, folder: str, docs: DataFrame) -> Model:
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return fit(docs, labels.where(~held_out(F.col("doc_id"))))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = score(docs.select("doc_id", "text"), toxicity_model(spark, folder, docs))
    return scored.select(
        "doc.doc_id",
        F.coalesce(held_out(F.col("doc.doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence",
    )


def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    groups = token_groups(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return with_counts(groups.withColumn("groups_sha256", digest).drop("groups")).select(
        "doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = shard_documents(table(spark, folder, "documents").select("doc_id", "text"), shards=40)
    return dealt.select(
        "doc.doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_multi_index": op2_multi_index,
    "op3_html_extraction": op3_html_extraction,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_suffix_array": op7_suffix_array,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_cross_tokenizer": op11_cross_tokenizer,
    "op12_sharding": op12_sharding,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op13_ranked_search": r"""
        WITH lowered AS (
            SELECT doc_id, translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ),
        words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered
        ),
        found AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM found GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM found, totals GROUP BY term
        ),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ),
        repeated AS (SELECT item_id, term, count(*) AS r FROM asked GROUP BY item_id, term),
        worth AS (
            SELECT f.doc_id, f.term,
                w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * l.n * t.docs) // t.terms))) AS score
            FROM found f JOIN lengths l USING (doc_id) JOIN weights w USING (term), totals t
        ),
        scored AS (
            SELECT r.item_id, s.doc_id, CAST(sum(r.r * s.score) AS BIGINT) AS score
            FROM repeated r JOIN worth s USING (term) GROUP BY r.item_id, s.doc_id
        ),
        numbered AS (
            SELECT item_id, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM numbered WHERE rank <= 20
    """,
    "op6_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(
                embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(
                list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ),
        numbered AS (
            SELECT query_id, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 5
    """,
    "op1_url_filters": """
        WITH parts AS (
            SELECT page_id, url, CASE WHEN strpos(url, '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ),
        split AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM parts
        ),
        named AS (
            SELECT page_id, path, translate(
                raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM split
        ),
        rules(rule, host, path, verdict) AS (
            VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
                ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
                ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
        ),
        ruled AS (
            SELECT n.page_id, arg_max(r.rule, length(r.rule)) AS rule,
                arg_max(r.verdict, length(r.rule)) AS verdict
            FROM named n JOIN rules r
                ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
            GROUP BY n.page_id
        ),
        bad AS (
            SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
            FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
        ),
        hosts AS (
            SELECT host, string_split(host, '.') AS labels, sum(bad) AS bad, count(*) AS n
            FROM named JOIN bad ON doc_id = try_cast(regexp_extract(path, '/([0-9]{1,18})', 1) AS BIGINT)
            WHERE host <> '' GROUP BY host
        ),
        hosted AS (
            SELECT host, bad, n, labels[-1] AS suffix,
                CASE WHEN len(labels) < 2 THEN host ELSE array_to_string(labels[-2:], '.') END AS domain
            FROM hosts
        ),
        everything AS (SELECT sum(bad) AS bad, sum(n) AS n, (sum(bad) + 1) / (sum(n) + 2) AS mean FROM hosted),
        tops AS (
            SELECT suffix, sum(h.bad) AS bad, sum(h.n) AS n, any_value(e.mean) AS prior
            FROM hosted h, everything e GROUP BY suffix
        ),
        top_weight AS (
            SELECT sum((bad - n * prior) ** 2) AS scatter, sum(n * prior * (1 - prior)) AS chance,
                sum(n * (n - 1) * prior * (1 - prior)) AS pairs,
                CASE WHEN pairs > 0 AND scatter > chance
                    THEN least(greatest(pairs / (scatter - chance) - 1, 1), 1000) ELSE 1000 END AS weight
            FROM tops
        ),
        top_means AS (SELECT t.*, weight, (bad + weight * prior) / (n + weight) AS mean FROM tops t, top_weight),
        middles AS (
            SELECT h.domain, sum(h.bad) AS bad, sum(h.n) AS n, any_value(t.mean) AS prior
            FROM hosted h JOIN top_means t USING (suffix) GROUP BY h.domain
        ),
        middle_weight AS (
            SELECT sum((bad - n * prior) ** 2) AS scatter, sum(n * prior * (1 - prior)) AS chance,
                sum(n * (n - 1) * prior * (1 - prior)) AS pairs,
                CASE WHEN pairs > 0 AND scatter > chance
                    THEN least(greatest(pairs / (scatter - chance) - 1, 1), 1000) ELSE 1000 END AS weight
            FROM middles
        ),
        middle_means AS (
            SELECT m.*, weight, (bad + weight * prior) / (n + weight) AS mean FROM middles m, middle_weight
        ),
        leaves AS (
            SELECT h.host, h.bad, h.n, m.mean AS prior FROM hosted h JOIN middle_means m USING (domain)
        ),
        leaf_weight AS (
            SELECT sum((bad - n * prior) ** 2) AS scatter, sum(n * prior * (1 - prior)) AS chance,
                sum(n * (n - 1) * prior * (1 - prior)) AS pairs,
                CASE WHEN pairs > 0 AND scatter > chance
                    THEN least(greatest(pairs / (scatter - chance) - 1, 1), 1000) ELSE 1000 END AS weight
            FROM leaves
        ),
        leaf_means AS (
            SELECT l.*, weight, (bad + weight * prior) / (n + weight) AS mean FROM leaves l, leaf_weight
        ),
        known AS (
            SELECT 'host' AS level, host AS name, mean, n, weight FROM leaf_means
            UNION ALL SELECT 'domain', domain, mean, n, weight FROM middle_means
            UNION ALL SELECT 'suffix', suffix, mean, n, weight FROM top_means
            UNION ALL SELECT 'all', '', mean, n, 2 FROM everything WHERE n > 0
        ),
        bounds AS (
            SELECT level, name, mean - 1.645 * sqrt(mean * (1 - mean) / (n + weight + 1)) AS bound FROM known
        ),
        looked_up AS (
            SELECT n.page_id, n.host, n.path, string_split(n.host, '.') AS labels FROM named n
        ),
        found AS (
            SELECT u.page_id, u.host, u.path,
                CASE WHEN u.host = '' THEN NULL WHEN h.name IS NOT NULL THEN 'host'
                    WHEN d.name IS NOT NULL THEN 'domain' WHEN s.name IS NOT NULL THEN 'suffix'
                    WHEN a.name IS NOT NULL THEN 'all' END AS level,
                CASE WHEN u.host <> '' THEN coalesce(h.bound, d.bound, s.bound, a.bound) END AS bound
            FROM looked_up u
            LEFT JOIN bounds h ON h.level = 'host' AND h.name = u.host
            LEFT JOIN bounds d ON d.level = 'domain'
                AND d.name = CASE WHEN len(u.labels) < 2 THEN u.host ELSE array_to_string(u.labels[-2:], '.') END
            LEFT JOIN bounds s ON s.level = 'suffix' AND s.name = u.labels[-1]
            LEFT JOIN bounds a ON a.level = 'all'
        )
        SELECT f.page_id, f.host, f.path, r.rule,
            coalesce(r.verdict, CASE WHEN f.bound > 0.3 THEN 'block' ELSE 'allow' END) AS verdict, f.level
        FROM found f LEFT JOIN ruled r USING (page_id)
    """,
    "op4_line_dedup": """
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ),
        lines AS (
            SELECT doc_id, lines[i] AS line, i,
                translate(
                    trim(lines[i], chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(32)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ) AS key
            FROM cut, unnest(range(1, len(lines) + 1)) AS t(i)
        ),
        shared AS (
            SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ),
        marked AS (
            SELECT l.*, s.first IS NOT NULL AND s.first <> l.doc_id AS dropped
            FROM lines l LEFT JOIN shared s USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), ''))
                AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
