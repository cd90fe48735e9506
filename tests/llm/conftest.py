import pytest


@pytest.fixture(scope="session")
def spark():
    from newsloom.session import local_session

    s = local_session("llm-tests", "4")
    s.sparkContext.setLogLevel("ERROR")
    return s
