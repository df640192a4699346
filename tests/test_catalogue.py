import duckdb
import pytest

from tessera.plans import audits, catalogue, pages, processors, reconcile, texts  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v) if v is not None and not isinstance(v, (int, bool)) else v


def rows(names, data):
    return sorted((tuple(plain(v) for v in r) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_matches_sql(spark, name):
    got = catalogue.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    data = got.select(*cols).collect()
    if name not in catalogue.ORACLE:
        assert data
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.ORACLE[name]})").fetchall()
    assert rows(cols, data) == rows(cols, want)
