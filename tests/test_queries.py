"""Registered queries against their SQL on the smallest tables.

``QUERIES=all`` runs every registered query; by default one of each kind runs.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
CORE = ["prepare_time", "mark_valid", "resample_index_linear", "segment_windows", "power_db_rel", "fit_channels",
        "canonicalize_links", "group_rows", "label_runs", "paint_labels", "capture_intervals", "annotation_join",
        "layer_metadata", "quality_report", "robust_range", "random_split", "group_holdout", "greedy_cover",
        "path_metadata", "read_numeric_csv", "external_split", "stream_windows", "prepare"]
NAMES = list(entry.queries()) if os.environ.get("QUERIES") == "all" else CORE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # the optional training-data queries have brute-force tests of their own where SQL cannot express them
    own = {name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note
