import duckdb
import pytest

from ..conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (id, text) pairs, with the usual and some
    clashing columns."""

    def make(texts):
        rows = [row if isinstance(row, tuple) else (number, row) for number, row in enumerate(texts)]
        full = [(i, t, "en", "s", None, 1, 2.0, 3, "x", "y") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long,"
            " label int, score double, length long, words string, _row string",
        )

    return make


@pytest.fixture
def table(spark, tmp_path):
    """Rows written as a table and read back, as the operators meet them."""

    def make(frame, parts=3):
        path = str(tmp_path / f"table-{len(list(tmp_path.iterdir()))}")
        frame.repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def sample():
    """The texts of the small test table, by id."""
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    return dict(rows)
