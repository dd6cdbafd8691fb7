import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from augury.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=4, shuffle_partitions=4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture()
def texts(spark):
    """Texts to a table of filings, numbered in order."""

    def make(*bodies, **columns):
        rows = [
            (columns.get("cik", "7"), "ACME", f"a-{i:04d}", columns.get("date", "2025-02-03"), "8-K", "u", t)
            for i, t in enumerate(bodies)
        ]
        return spark.createDataFrame(
            rows,
            "cik string, company_name string, accession_number string, date_filed string, "
            "form_type string, exhibit_url string, text string",
        )

    return make
