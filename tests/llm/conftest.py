import pytest
from llm_rows import SF, TEXTS


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with names of the operators' own."""
    rows = [
        (i, t, "en", None, len(t) if t else None, "x", 1, "k", 0.5, None, 3, True, "w", "s", "h") for i, t in TEXTS
    ]
    return spark.createDataFrame(
        rows,
        """doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id long,
           row_key string, key double, log_weight double, block int, guard boolean, win string, spans string, ids string""",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}
