import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text[, lang[, source]]) as a table of documents."""

    def make(rows):
        full = [(*r, *[None, "s"][len(r) - 2 :])[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCS)

    return make
