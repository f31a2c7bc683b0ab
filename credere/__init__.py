"""credere: a PySpark-native engine for tabular decision data.

Delimited ingest, data-quality profiling, cleaning and imputation,
categorical/numeric feature building, distributed classifier training,
evaluation, tuning, run tracking and batch/stream scoring - all expressed
with the DataFrame API so Catalyst plans the work.
"""

from .profile import LINEITEM, LOAN, Profile  # noqa: F401

__version__ = "0.1.0"
