import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("OMP_NUM_THREADS", "1")

from larder.session import local_session, ship  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "6g", "larder-tests")
    session.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def oracle(small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def _norm(x):
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (list, tuple)):
        return [_norm(y) for y in x]
    return x


@pytest.fixture(scope="session")
def same():
    """Whether a DataFrame and a DuckDB result hold the same rows, in any order."""

    def check(df, result):
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        order = sorted(names)
        got = sorted(repr([_norm(r[c]) for c in order]) for r in df.collect())
        want = sorted(repr([_norm(r[names.index(c)]) for c in order]) for r in result.fetchall())
        assert got == want

    return check
