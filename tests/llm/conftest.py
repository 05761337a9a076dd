import pytest


@pytest.fixture(scope="session", autouse=True)
def code_on_workers(spark):
    """Workers find this package wherever the tests are started from."""
    from beneflow.llm.queries import on_workers

    on_workers(lambda session: None)(spark)
