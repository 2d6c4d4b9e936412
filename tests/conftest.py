import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from domloom.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8, 4, **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
