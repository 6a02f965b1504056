import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
VIEWS = ("region nation customer supplier part orders lineitem events documents "
         "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def _duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for v in VIEWS:
        p = f"{sf_dir}/{v}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="session")
def duck():
    return _duck(SF001)


@pytest.fixture(scope="session")
def star(spark):
    from shelfwise.sources.star import build_star
    return build_star(spark, SF001)


@pytest.fixture
def scratch(spark):
    from shelfwise.session import new_scratch
    def make(name="t"):
        return new_scratch(spark, name)
    return make
