from tests.conftest import rows  # noqa: F401
