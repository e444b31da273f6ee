import pytest

from broadsheet.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", **{
            "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan(spark):
    """Physical plan of a DataFrame as text."""

    def text(df) -> str:
        return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    return text
