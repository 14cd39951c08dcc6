"""Registered queries next to their SQL, at the smallest scale."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
check = pytest.importorskip("check_queries")

SMALL = "/root/testdata/sf0.001"
QUICK = (
    "f1_f2_f3_f4_timestamps", "f5_collapse_ws", "f12_error_details", "j1_j2_p1_assign_speaker",
    "w1_build_turns", "j3_a1_landmark_votes", "j6_search_clips", "q1_q2_snk9_transcript_audit",
    "c5_c3_backlog", "t1_ranked_offers", "p11_sliding_windows", "g3_f11_pair_peaks", "p1_nested_units",
)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_same_rows(spark, name):
    import __spark_entry__ as entry

    problem, *_ = check.compare(spark, check.duck(SMALL), SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_every_query_has_sql():
    from speechlake.plans import catalog

    assert set(catalog.queries()) == set(catalog.oracles())
