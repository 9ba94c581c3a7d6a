"""Contract-driven snapshot tables on Spark: ingest, validate, model, monitor.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing here creates a session.  See the README for the layout.
"""

from snapstrata.contract import LeadTimeBands, SnapshotContract

__all__ = ["LeadTimeBands", "SnapshotContract"]
