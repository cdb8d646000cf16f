import pytest

from pyspark import cloudpickle

import tidelog

cloudpickle.register_pickle_by_value(tidelog)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one that clashes with results."""
    def make(rows, extra="n_hit"):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra} string")
    return make
