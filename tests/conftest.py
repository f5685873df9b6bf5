import pytest

from lexshelf.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {"spark.sql.warehouse.dir": "warehouse", "spark.checkpoint.dir": "shared"}
    return local_session(4, "tests", **{k: str(tmp_path_factory.mktemp(v)) for k, v in folders.items()})
