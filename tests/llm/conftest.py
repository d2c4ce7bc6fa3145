import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from brute import SF


@pytest.fixture(scope="session")
def sf_rows(spark):
    """sf_rows(table, *columns) -> tuples of a small test table."""
    return lambda name, *cols: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]
