from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, n long, tile long, key string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with further columns whose names operators also use; rows are (doc_id, text[, lang[, source]])."""

    def made(*rows):
        filled = [(i, t, *(list(more) + [None, None])[:2], None if t is None else len(t), "x", "x", 7, 7, "x") for i, t, *more in rows]
        return spark.createDataFrame(filled, DOCS)

    return made


@pytest.fixture(scope="session")
def vectors(spark):
    def made(*rows):
        return spark.createDataFrame([(i, v, 7, 7.0, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, score double, vector string")

    return made


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
