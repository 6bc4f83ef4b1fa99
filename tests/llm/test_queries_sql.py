import duckdb
import pytest

from evidora.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duck.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(want.fetchall())


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
