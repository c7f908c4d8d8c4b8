import pytest

from millrace.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", partitions=3, spark__ui__enabled="false", spark__driver__memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def many_blocks(spark):
    """Keep every range partition, so that small inputs span several blocks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")
