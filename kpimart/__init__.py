"""kpimart: monthly KPI measure marts as Spark DataFrame plans.

Layers:
  functions/  column expressions (dates, flags, labels)
  operators/  DataFrame operators (calendar, scope, joins, measures, stack)
  sources/    scans with declared columns, mart sink, staging, test adapters
  plans/      the four marts as measure specs, plain and one-pass plans
"""

from kpimart.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
__version__ = "0.1.0"
