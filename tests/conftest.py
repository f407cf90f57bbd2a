import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from provtally.session import local_session

    session = local_session("8", shuffle_partitions=4, memory="6g")
    session.conf.set("provtally.work.dir", str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF
