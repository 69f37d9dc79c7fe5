"""The pipeline against its stages written out plainly, and every query on the smallest tables."""

import hashlib
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import queries, templates
from tests.llm.conftest import SF
from tests.llm.test_formats import BYTES, ids_of
from tests.llm.test_groups import slow_groups
from tests.llm.test_texts import slow_spans


def slow_pipeline(rows, items):
    rows = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    leaders = {c for _, _, c in slow_groups(rows)}
    rows = [(d, t) for d, t in rows if d in leaders]

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    asked = [shingles(t) for t in items]
    rows = [(d, t) for d, t in rows if not any(len(a & shingles(t)) >= 0.9 * len(a) for a in asked)]
    out = []
    for doc, text in rows:
        parts, done = [], 0
        for start, _, stop in slow_spans(text):
            if start >= done:
                parts += [text[done:start], "[secret]"]
            done = max(done, stop)
        ids = ids_of(BYTES, "".join([*parts, text[done:]]))
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    return sorted(out)


def test_pipeline(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert sorted(map(tuple, found)) == slow_pipeline(rows, items)


def test_stages_return_documents(spark, odd, nothing):
    for docs in (odd.select(*corpus_pipeline.COLUMNS), nothing, odd):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == corpus_pipeline.COLUMNS
        docs.collect()


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "redact", "tokenize"]
    assert sorted(queries.QUERIES) == sorted([*(f"op{n}" + q[len(f"op{n}") :] for n in range(1, 14) for q in queries.QUERIES if q.startswith(f"op{n}_")), "pipeline"])
    assert "und" and templates.WINDOW == 5 and templates.SIMILARITY == 0.8


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_are_registered(spark, name):
    import __spark_entry__ as driver

    assert driver.queries()[name] is queries.QUERIES[name]
    assert (name in driver.oracle_sql()) == (name in ("op4_embedding_dedup", "op8_warc"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert sorted(map(tuple, ours.select(*theirs.columns).collect())) == sorted(theirs.fetchall())


def test_a_missing_language_is_filled_in(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bare = docs.withColumn("lang", F.when(F.col("doc_id") % 10 != 3, F.col("lang")))
    kept = corpus_pipeline.language_id(spark, bare, SF)
    both = kept.select("doc_id", F.col("lang").alias("found")).join(docs, "doc_id").filter("lang IS NOT NULL AND found IS NOT NULL")
    assert kept.filter("lang IS NULL").isEmpty()
    assert both.filter("doc_id % 10 != 3 AND found <> lang").isEmpty()
    assert both.filter("found = lang").count() >= 0.97 * both.count()


@pytest.fixture(scope="module")
def odd_tables(spark, odd, tmp_path_factory):
    """A folder of tables with NULLs in every column, empty, repeated and long rows, and columns that clash."""
    root = str(tmp_path_factory.mktemp("odd"))
    ids = [r["doc_id"] for r in odd.collect()]
    long_page = "<p>" + "x y " * 600_000
    tables = {
        "documents": odd,
        "benchmark": spark.createDataFrame([(None, None), (1, ""), (2, "the same words in two rows"), (2, "other words here now then")], "item_id long, text string"),
        "labels": spark.createDataFrame([(i, n % 2, n % 3 % 2) for n, i in enumerate(ids)] + [(4, None, None)], "doc_id long, quality int, toxic int"),
        "pages": spark.createDataFrame(
            [(None, None, None), (None, "u", "a"), (None, "u", "a"), (3, "u", "a"), (2, None, "a"), (4, "v\r\nX: y", ""), (5, "w", long_page), (6, "w", long_page), (6, "é", "b")],
            "page_id long, url string, html string",
        ),
        "embeddings": spark.createDataFrame(
            [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (None, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [1.0]), (9, [None, 1.0])],
            "vec_id long, embedding array<float>",
        ),
        "conversations": spark.createDataFrame(
            [(None, 1, "a", "b"), (3, None, None, None), (3, None, None, None), (7, 1, "user", "x " * 100_000), (20, 0, "user", ""), (21, 5, None, "y")],
            "conv_id long, turn long, role string, text string",
        ),
    }
    for name, df in tables.items():
        clash = {c: F.lit(c) for c in ("score", "word", "n", "links", "first", "key", "part", "size") if c not in df.columns}
        df.withColumns(clash).repartition(3).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_odd_tables(spark, odd_tables, name):
    rows = queries.QUERIES[name](spark, odd_tables).collect()
    documents = spark.read.parquet(f"{odd_tables}/documents.parquet").count()
    each = {"op4_embedding_dedup": 9, "op8_warc": 9, **{f"op{n}_": documents for n in (1, 2, 3, 5, 6, 9, 10, 12)}}
    expected = next((v for k, v in each.items() if name.startswith(k)), None)
    assert expected is None or len(rows) == expected
    if name == "op8_warc":
        kinds = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in rows}
        assert kinds[2, 1] == ("response", None) and kinds[3, 1] == ("revisit", 2) and kinds[None, 1] == ("revisit", 2)
        assert kinds[6, 2_400_003] == ("revisit", 5)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    for table in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_entry_without_the_folder(monkeypatch):
    import __spark_entry__ as driver

    for module in [m for m in sys.modules if m.startswith("lamina.llm")]:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.setitem(sys.modules, "lamina.llm", None)
    assert not any(name.startswith("op") for name in driver.queries())
