"""masklens: masking-run log analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; the work
runs as Catalyst plans (scans, projections, windows, joins, aggregates), never
in driver loops.
"""

__version__ = "0.1.0"

from masklens.operators.calendar import date_dimension, drilldown, relate_dates  # noqa: E402
from masklens.operators.config import config_quarantine, config_union, flatten_config  # noqa: E402
from masklens.operators.contract import (  # noqa: E402
    conform_operations, parse_landed_lines, parse_masking_logs, quarantine_documents, silver_operations,
)
from masklens.operators.joins import ops_config_join, ops_own_config  # noqa: E402
from masklens.session import apply_conf  # noqa: E402

__all__ = [
    "apply_conf", "parse_masking_logs", "parse_landed_lines", "conform_operations", "silver_operations",
    "quarantine_documents", "flatten_config", "config_union", "config_quarantine", "ops_config_join",
    "ops_own_config", "date_dimension", "relate_dates", "drilldown",
]
