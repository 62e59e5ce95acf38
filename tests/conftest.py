from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import duck  # noqa: E402
from feira import build_session, run_etl  # noqa: E402
from feira.sources.order_tables import raw_from_order_tables  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=8, spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return raw_from_order_tables(spark, SF)


@pytest.fixture(scope="session")
def star_out(raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    run_etl(raw, out)
    return out


@pytest.fixture(scope="session")
def star(spark, star_out):
    from feira import open_star

    return open_star(spark, star_out)


@pytest.fixture(scope="session")
def con():
    return duck(SF)
