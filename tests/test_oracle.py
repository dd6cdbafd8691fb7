"""A choice of registered queries against their SQL at the smallest scale.

All of them: ``python -m checks.compare DIR``.
"""

import os

import pytest

import __spark_entry__ as entry
from checks import oracles, queries
from checks.compare import connect, difference

DIR = "/root/testdata/sf0.001"
CHOICE = [
    "a1_summarise_panel", "d2_dedup_panel", "e5_first_exhibit", "e7_strip_html", "f12_document_key",
    "g0_extract_guidance", "g1_split_sentences", "s1_scan_master_index", "x1_prefilter_text",
    "x4_map_to_guidance", "z1_build_filing_index",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


def test_every_query_has_sql():
    assert set(queries.registry()) == set(oracles.oracles())
    assert len(queries.registry()) > 80
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHOICE)
def test_query(spark, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert difference(spark, connect(DIR), DIR, query, sql) is None
