"""Queries over all releases, on the smallest tables that hold more than two."""

import os

import pytest

from tallyforge.plans import catalog
from tallyforge.session import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def test_every_release_reaches_the_log_and_is_compared(spark):
    releases = {r[0] for r in table(spark, DATA, "link_snapshots").select("release_no").distinct().collect()}
    assert len(releases) > 2
    run = catalog.queries()
    assert {r.release_no for r in run["sink_change_log_all"](spark, DATA).collect()} == releases
    for name in ("removed_ids_all", "multiset_gaps_all"):
        assert {r.release_no for r in run[name](spark, DATA).collect()} - {1, 2}, name
    assert {r.record_key.partition("|")[0] for r in run["diff_full_outer_all"](spark, DATA).collect()} - {"1", "2"}
