import pytest

from tests.conftest import spark as spark  # noqa: PLC0414

@pytest.fixture(scope="session")
def tables_dir():
    return "/root/testdata/sf0.001"
