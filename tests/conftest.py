import pytest

from folioflow.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "2000",
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
