import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from marquee.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", "marquee-tests", shuffle_partitions=8)
    yield session


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text[, source]) with columns whose names clash
    with names that the operators use."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "x", 7) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, node string, size int"
        )

    return make
