"""Every registered query of the engine against its SQL on the same tables."""

from datetime import datetime
from pathlib import Path

import duckdb
import pytest

from touchline.plans import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return x.replace(tzinfo=None) if isinstance(x, datetime) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(core.QUERIES) == set(core.ORACLES) and len(core.QUERIES) == 102


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    got = con.execute(core.ORACLES[name])
    names = [c[0] for c in got.description]
    df = core.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
