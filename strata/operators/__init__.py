"""Generic DataFrame operators used by the gold layer and the extracts."""

from strata.operators.topn import top_n_per_group, top_k  # noqa: F401
from strata.operators.metrics import Metric, long_metrics  # noqa: F401
from strata.operators.totals import decimal_mean, group_and_total  # noqa: F401
from strata.operators.representative import smallest_row  # noqa: F401
from strata.operators.semijoin import keep_keys  # noqa: F401
from strata.operators.numbering import number_within  # noqa: F401
from strata.operators.sample import sample_rows  # noqa: F401
from strata.operators.expectations import (  # noqa: F401
    expectation_counts, expectation_report, observe_expectations,
)
