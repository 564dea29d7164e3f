"""Every query that has SQL gives the rows the SQL gives."""

import os

import pytest
from compare import difference

from casefeatures.checks.oracles import ORACLES
from casefeatures.checks.queries import QUERIES

# These plan for a minute each, the whole job for two; CASEFEATURES_ALL=1 runs them too.
WIDE = {"table_credit_bureau_a_1", "table_credit_bureau_b_1", "table_applprev_1", "table_person_1", "assemble_features"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, name):
    if name in WIDE and not os.environ.get("CASEFEATURES_ALL"):
        pytest.skip("wide")
    assert difference(QUERIES[name](spark, small), ORACLES[name], small) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize(
    "name",
    ["seq_tail_mean", "seq_diff_std", "seq_lines", "agg_argmax_pos", "agg_positive", "agg_median", "rollup_depth1", "table_tax_registry_a_1",
     "encode_ordinal", "encode_index", "auc", "cv_summary"],
)
def test_query_matches_sql_when_most_groups_are_hot(spark, small, rows_per_task, name):
    rows_per_task(5)
    assert difference(QUERIES[name](spark, small), ORACLES[name], small) is None
