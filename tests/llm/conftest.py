import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    def read(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, a null id, repeated rows and columns that operators use inside."""
    from brute import ODD_TEXTS

    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", 1, "x", 2, "y", "z", 3, "k") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[0], (None, "some text of a row without an id", "en", "s", 1, "x", 2, "y", "z", 3, "k")]
    names = "doc_id long, text string, lang string, source string, n long, key string, fp long, spans string, text_key string, n_chars long, text_bytes string"
    return spark.createDataFrame(rows, names)
