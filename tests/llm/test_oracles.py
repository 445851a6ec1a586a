"""The SQL of the corpus queries gives the queries' rows."""

import random

import duckdb
import pytest

from tilewright.llm import host_reputation, oracles, queries, sentence_spans, sharding
from tilewright.llm.common import read

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def same(frame, con, sql):
    got = con.sql(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(frame.columns)
    want = [tuple(r) for r in frame.select(*got.column_names).collect()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r.values())) for r in got.to_pylist())
    return want


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_equals_the_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert same(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])


def put(con, name, frame):
    con.register("given", frame.toArrow())
    con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")


def test_sql_of_shards_on_hard_rows(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "é🙂" * 40), (5, "x" * 3000), (4, "it's")]
    for n in range(len(rows) + 1):
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string")
        con = duckdb.connect()
        put(con, "documents", docs)
        assert len(same(sharding.feistel_shards(docs, 3, 7), con, oracles.feistel_shards_sql(3, 7))) == n


def test_sql_of_reputation_on_hard_rows(spark):
    urls = [None, "", "no scheme", "http://", "ftp://A.Example.NET/en/x?y", "http://net/", "x://b.co.uk#f", "x://c.b.co.uk/", "x://a.org/fr/\n"]
    pages = spark.createDataFrame([(i % 40, u) for i, u in enumerate(urls * 20)] + [(None, urls[4])], "page_id long, url string")
    labels = spark.createDataFrame(
        [(i, i % 3 and 1, int(i % 4 == 0)) for i in range(35)] + [(36, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for some in (labels, labels.limit(0)):
        con = duckdb.connect()
        put(con, "pages", pages)
        put(con, "labels", some)
        got = host_reputation.judge_urls(pages, some, queries.URL_RULES)
        assert len(same(got, con, oracles.host_reputation_sql(queries.URL_RULES))) == 181


def test_sql_of_sentence_spans_on_hard_rows(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice(["lor", "em", "é日", "a"]) for _ in range(rng.choice([1, 3, 8, 14, 15, 25, 40]))) for _ in range(12)]
    ends = [". ", "!\n", "。", "?) \u3000", "\n\n", ".x ", " \x1f", ".\x85", "...\"' "]
    rows = [(i, "".join(rng.choice(pool) + rng.choice(ends) for _ in range(rng.randrange(9)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n "), (None, rows[7][1]), rows[3], rows[3], (203, (pool[0] + ". ") * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    put(con, "documents", docs)
    got = sentence_spans.substring_dedup(docs)
    assert sum(r[-1] > 0 for r in same(got, con, oracles.sentence_spans_sql())) > 10


def test_tables_of_the_sql_are_whole(spark):
    for name in ("documents", "pages"):
        n = read(spark, SF, name).count()
        query = "op1_host_reputation" if name == "pages" else "op3_feistel_shards"
        assert queries.QUERIES[query](spark, SF).count() == n
