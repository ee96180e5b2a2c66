import pytest

from beaconry.session import build_session, clear_scratch, tune


@pytest.fixture(scope="session")
def spark():
    session = build_session("beaconry-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.sql.ui.retainedExecutions": "1"})
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    clear_scratch(session)
    session.stop()


@pytest.fixture
def shuffled(spark):
    """No broadcasts, neither asked for nor chosen by Spark."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)
