"""Every registered query on small odd tables: nulls, empty and long texts, repeated rows, clashing columns, no rows."""

from __future__ import annotations

import random

import duckdb
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from tillwork.llm import queries, tables

#: Columns that bear names the operators use themselves.
CLASHES = ("score", "n", "part", "kind", "host", "ids", "spans", "decontamination", "lang_pred", "ambiguous", "quality", "item", "component", "failures", "counts", "leader")


def write(spark, folder, documents, benchmark, pages, labels, clashes):
    def save(rows, schema, name):
        df = spark.createDataFrame(rows, schema)
        for column in clashes if name != "labels" else ():
            df = df.withColumn(column, F.lit("clash"))
        df.repartition(2).write.parquet(f"{folder}/{name}.parquet")

    save(documents, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    save(benchmark, "item_id long, text string", "benchmark")
    save(pages, "page_id long, url string, html string", "pages")
    save(labels, "doc_id long, quality int, toxic int", "labels")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory, corpus, prose):
    rng = random.Random(3)
    documents = [(doc_id, text, rng.choice(["en", "de", None]), None if doc_id % 9 == 0 else "s", None if text is None else len(text)) for doc_id, text in corpus]
    documents += [(None, "no id here " * 30, "en", "s", 1), (None, None, None, None, None), documents[3], documents[3]]
    benchmark = [(1, " ".join(corpus[20][1].split()[:14])), (None, None), (2, "")]
    pages = [(1, None, None), (2, "http://a.com/x/1", "<article><p>Hello there.</p></article>"), (2, "http://a.com/x/1", "<article><p>Hello there.</p></article>"), (3, "", ""), (None, "x", "<p>y")]
    labels = [(k, k % 2, 0) for k in range(40)] + [(41, None, None), (None, 1, 1), (10**9, 0, 0)]
    return write(spark, tmp_path_factory.mktemp("odd") / "t", documents, benchmark, pages, labels, CLASHES), documents, benchmark


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("none") / "t", [], [], [], [], ())


ROW_KEYS = {"op2_url_filters": "pages", "op9_html_extraction": "pages"}
#: Queries whose rows are not those of one table; their own tests compare them with brute force.
OTHER_ROWS = ("op11_filter_audit", "op12_lexical_search", "op13_best_fit_packing")
PER_ROW = [name for name in queries.QUERIES if name not in OTHER_ROWS]


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row_whatever_it_holds(spark, odd, name):
    folder, *_ = odd
    rows = queries.QUERIES[name](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/{ROW_KEYS.get(name, 'documents')}.parquet").count()
    again = queries.QUERIES[name](spark, folder).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if name in OTHER_ROWS])
def test_odd_rows_give_the_same_result_twice(spark, odd, name):
    folder, *_ = odd
    rows = queries.QUERIES[name](spark, folder).collect()
    assert rows and sorted(map(str, rows)) == sorted(map(str, queries.QUERIES[name](spark, folder).collect()))


@pytest.mark.parametrize("name", queries.QUERIES)
def test_empty_tables_give_no_rows(spark, none, name):
    assert queries.QUERIES[name](spark, none).collect() == []


def test_texts_of_one_id_are_documents_of_their_own(spark, prose):
    """Id 3 has a copy of 1, a text of its own and a text that 7 copies; equal rows are one."""
    rows = [(1, prose(1, 40), "a"), (3, prose(1, 40), "b"), (3, prose(3, 40), "c"), (3, prose(3, 40), "c"), (3, prose(4, 40), "d"), (7, prose(4, 40), "e"), (3, None, "f")]
    documents = spark.createDataFrame([*rows, (None, "x", "g")], "doc_id long, text string, source string")
    found = corpus_pipeline.drop_near_copies(spark, documents, "")
    assert found.columns == documents.columns
    kept = sorted((tuple(row) for row in found.collect()), key=str)
    texts = [text for _, text, _ in kept]
    assert len(kept) == 5 and set(texts) == {row[1] for row in rows} | {"x"}
    assert (1, prose(1, 40), "a") in kept and (3, prose(3, 40), "c") in kept and (3, None, "f") in kept


def test_pipeline_on_empty_tables(spark, none):
    assert corpus_pipeline.run(spark, none).count() == 0


@pytest.mark.parametrize("name", [name for name in queries.ORACLES if name in PER_ROW])
def test_sql_agrees_on_odd_tables(spark, odd, name):
    folder, *_ = odd
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        rows = "SELECT DISTINCT ON (doc_id) * FROM t WHERE doc_id IS NOT NULL" if table == "documents" else "SELECT * FROM t"
        connection.sql(f"CREATE VIEW {table} AS WITH t AS (SELECT * FROM '{folder}/{table}.parquet/*.parquet') {rows}")
    theirs = connection.sql(queries.ORACLES[name])
    columns = theirs.columns
    found = queries.QUERIES[name](spark, folder)
    if "doc_id" in columns:
        found = found.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, (tuple(row) for row in found.select(columns).collect()))) == sorted(map(str, theirs.fetchall()))


def test_results_of_repeated_rows_and_brute_force(spark, odd, corpus):
    folder, documents, benchmark = odd
    known = [(row[0], row[1]) for row in documents if row[0] is not None]
    found = {row["doc_id"]: row for row in queries.QUERIES["op8_ngram_jaccard_join"](spark, folder).collect()}
    expected = plain.near_groups(known)
    assert {k: (row["n_shingles"], row["component_id"]) for k, row in found.items() if k is not None} == expected
    assert found[None]["component_id"] is None
    removed = {row["doc_id"]: row["n_removed"] for row in queries.QUERIES["op1_suffix_array_dedup"](spark, folder).collect()}
    assert {k: v for k, v in removed.items() if k is not None} == {k: v[1] for k, v in plain.repeats(dict(known).items()).items()}
    assert removed[None] == 0


def test_all_are_registered():
    names = registry.queries()
    assert [f"op{k}_" for k in range(1, 14) if not any(name.startswith(f"op{k}_") for name in names)] == []
    assert "pipeline" in names and set(queries.ORACLES) <= set(registry.oracle_sql())


def test_stages_keep_columns_and_order(spark, odd):
    folder, *_ = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, folder)
        assert result.schema.names == docs.schema.names and [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]
        assert result.select("score").distinct().collect() == [("clash",)]


def test_pipeline_as_by_brute_force(spark, odd, prose):
    """Stage by stage against the plain versions, on what the stage before has kept."""
    folder, _, benchmark = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    identify, near, decontaminate, mask, encode = (stage for _, stage in corpus_pipeline.STAGES)

    def written(df):
        return tables.cut(spark, df, "stage")

    def texts(df):
        return {row["doc_id"]: row["text"] for row in df.where("doc_id is not null").collect()}

    before, kept = texts(docs), texts(first := written(identify(spark, docs, folder)))
    assert {k for k in before if not any(c.isalpha() for c in before[k] or "")} & set(kept) == set()
    assert all(before[k] == text for k, text in kept.items()) and len(kept) > 0.8 * len(before)
    groups = plain.near_groups(kept.items())
    assert set(texts(second := written(near(spark, first, folder)))) == {k for k, (_, low) in groups.items() if k == low}
    hits = plain.contamination(texts(second).items(), benchmark)
    clean = texts(third := written(decontaminate(spark, second, folder)))
    assert set(clean) == {k for k, (words, hit, *_) in hits.items() if 2 * hit <= words}
    assert not any(hit for *_, hit in plain.contamination(clean.items(), benchmark).values())
    masked = texts(fourth := written(mask(spark, third, folder)))
    assert all(masked[k] == text for k, text in clean.items() if not plain.personal_data(text))
    tokens = encode(spark, fourth, folder).collect()
    assert {row["doc_id"] for row in tokens if row["doc_id"] is not None} == set(masked)
    assert all(row["n_tokens"] == len(row["ids"]) for row in tokens)
