import zlib

import corpus_pipeline
from corpus_pipeline import STAGES, run
from skytally.llm.packing import pack
from skytally.llm.queries import toxicity_model
from skytally.llm.toxicity import score
from tests.conftest import SF_DIR
from tests.llm.test_lines import brute_force as lines_left
from tests.llm.test_packing import PATH
from tests.llm.test_packing import check as check_packed
from tests.llm.test_repeats import brute_force as bytes_left
from tests.llm.test_simhash import groups, plain_fingerprint


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def expected_texts(spark, docs, folder):
    """The documents before packing, by the plain versions of the stages."""
    model = toxicity_model(spark, folder, spark.read.parquet(f"{folder}/documents.parquet"))
    kept = score(docs, model).where("score < 0.7").select("doc.doc_id", "text").collect()
    texts = {i: t for i, _, _, t in lines_left([tuple(r) for r in kept])}
    ids = sorted(texts)
    label = groups([plain_fingerprint(texts[i]) for i in ids])
    texts = {i: texts[i] for at, i in enumerate(ids) if label[at] == at}
    return {i: r[3].decode(errors="ignore") for i, r in bytes_left(texts, 100).items()}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = expected_texts(spark, docs, SF_DIR)
    assert 0 < len(texts) < docs.count()
    rows = run(spark, SF_DIR).collect()
    check_packed(rows, texts, 1024)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.limit(5).selectExpr(
        "CASE WHEN doc_id % 2 = 0 THEN doc_id END AS doc_id", "CAST(NULL AS STRING) AS text",
        "lang", "source", "CAST(NULL AS BIGINT) AS n_chars",
    )
    docs = docs.unionByName(docs.limit(3)).unionByName(odd).selectExpr(
        "*", "1 AS id", "'x' AS kept", "2 AS doc", "3 AS score", "4 AS `a.b`", "5 AS fingerprint"
    )
    for name, stage in STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        assert found.dtypes == docs.dtypes, name
        assert 0 < found.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
        same = found.where("text IS NOT NULL").selectExpr("bool_and(n_chars = length(text))")
        assert same.first()[0]


def test_clean_documents_stay(spark):
    clean = spark.createDataFrame(
        [(i, f"word{i} other{i} more{i}\nline number {i} stands alone here", "en", "s", 9) for i in range(40)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in STAGES[:-1]:
        found = stage(spark, clean, SF_DIR)
        assert rows_of(found.select("doc_id", "text")) == rows_of(clean.select("doc_id", "text")), name
    assert corpus_pipeline.ORACLE_SQL is None


def test_packed_ids_are_those_of_the_texts(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: zlib.crc32(r.ids) for r in pack(docs, PATH).collect()}
    assert rows[2] == zlib.crc32(b"\0\0\0\0")


def test_near_dedup_loses_no_text(spark):
    """Rows that share an id stay, if they are no copies of one another."""
    a, b, c = "one two three four five", "nothing like the other text at all", "a third text of its own here"
    rows = [(1, a, "x"), (1, b, "y"), (2, c, "z"), (3, a, "w"), (2, c, "z"), (None, a, "n"), (4, None, "q"), (5, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 5):
        found = corpus_pipeline.near_dedup(spark, docs.repartition(parts), "")
        assert found.columns == docs.columns
        assert rows_of(found) == sorted(
            [(1, a, "x"), (1, b, "y"), (2, c, "z"), (None, a, "n"), (4, None, "q")], key=str
        )
