import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Extra columns named like what the operators use inside and return.
CLASH = ("score", "id", "fp", "start", "n_tokens", "text_", "h1", "mark", "component_id", "k", "length")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from quarry.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """docs(rows) -> DataFrame of (doc_id, text) with clashing extra columns,
    half of them null."""
    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + \
            ", ".join(f"{c} string" for c in CLASH)
        full = [(i, t, None if (i or 0) % 2 else "en", None, None if t is None else len(t),
                 *(None if (i or 0) % 2 else "x" for _ in CLASH)) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(parts)
    return make




@pytest.fixture(scope="session")
def odd(frame):
    from llm_rows import ODD
    return frame(ODD)


@pytest.fixture(scope="session")
def sample():
    import duckdb
    from llm_rows import SF
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet' order by doc_id").fetchall()
