import pytest


@pytest.fixture
def table(spark):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns that clash."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "x", 1.5) for r in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, N_Words string, score double"
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables as a data folder."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
