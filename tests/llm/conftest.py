import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(autouse=True)
def _workers_import_the_package(spark):
    from fieldspark.llm.common import ready

    ready(spark)
