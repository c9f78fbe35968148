"""Compare a query with its SQL twin in DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows, places=9):
    def one(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, places)
        return tuple(map(one, v)) if isinstance(v, (list, tuple)) else v

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


def same(df, con, sql):
    names = sorted(df.columns)
    want = con.sql(sql)
    assert sorted(want.columns) == names
    got = plain(tuple(r) for r in df.select(*names).collect())
    expected = plain(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    assert len(got) == len(expected), (len(got), len(expected))
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    assert not wrong, wrong[:3]
