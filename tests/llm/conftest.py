import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import AWKWARD  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with extra columns whose names operators use themselves."""
    rows = [(i, t, "en" if k % 2 else None, "s", len(t or ""), 1, "x", 2) for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long, spans string, twin int")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
