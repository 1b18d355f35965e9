import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scholion.llm.common import findable  # noqa: E402


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_library(spark):
    findable(spark)
