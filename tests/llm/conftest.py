import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, sources=None, ids=None, extra=None):
    """A documents table from texts; ``extra``: name -> value of additional columns with clashing names."""
    rows = [(ids[i] if ids else i, t, "en", sources[i] if sources else f"s{i % 3}",
             None if t is None else len(t)) for i, t in enumerate(texts)]
    schema = DOCS
    for name, value in (extra or {}).items():
        schema += f", `{name}` string"
        rows = [(*r, value) for r in rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def sample_texts():
    """Whole texts of the smallest documents table, by id."""
    import pyarrow.parquet as pq
    rows = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    return {r["doc_id"]: r for r in rows}
