import os

import pytest

EXTRA = ["sig", "range", "guest", "mark", "key", "list", "_place", "_mix", "_mark", "_drop", "score", "lang_pred",
         "n_lines", "n_dropped", "_found", "_lines", "comp", "a", "b"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table with extra columns whose names clash with internal ones."""
    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * len(EXTRA)))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.exists(path):
        pytest.skip("no smoke data")
    return path
