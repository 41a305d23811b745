"""Every registered query with an oracle, against DuckDB on the smallest tables."""

import duckdb
import pytest

from tarn import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(round(r[k], 9) if isinstance(r[k], float) else r[k] for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name in queries.ORACLES:
        want = duck.sql(queries.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(rows, got.columns) == plain(want.fetchall(), want.columns)


def test_entry_survives_without_the_corpus_operators():
    import subprocess
    import sys

    code = "import sys; sys.modules['tarn.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'summarise' in e.queries() and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 2)[0])
