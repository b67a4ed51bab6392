import pytest

from marquee.session import apply_settings
from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    spark = apply_settings(session())
    yield spark
    spark.stop()
