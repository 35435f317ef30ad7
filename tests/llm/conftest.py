import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from playbill.llm.common import ship  # noqa: E402
from playbill.session import local_session  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    session = local_session("playbill-llm-tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    ship(session)
    return session


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def make(rows, **more):
        full = [(i, text, more.get("lang"), f"src{(i or 0) % 3}", None if text is None else len(text)) for i, text in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "1 AS key", "'x' AS id", "2 AS rank", "3 AS n", "4 AS component", "5 AS h", "6 AS block", "7 AS version", "8 AS spans")

    return make
