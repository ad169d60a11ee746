import pytest

from brute import CLASHES


@pytest.fixture
def make_docs(spark):
    """rows of (doc_id, text[, source]) -> documents with every clashing column beside them, in several partitions."""

    def make(rows, clash=True, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        extra = "".join(f", `{c}` string" for c in CLASHES) if clash else ""
        values = [r + (tuple(f"{c} {i}" for c in CLASHES) if clash else ()) for i, r in enumerate(full)]
        return spark.createDataFrame(
            values, "doc_id long, text string, lang string, source string, n_chars long" + extra).repartition(partitions)

    return make
