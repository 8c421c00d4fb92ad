import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sitepulse.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    settings = {"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"}
    return local_session(4, shuffle_partitions=4, **settings)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
