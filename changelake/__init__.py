"""changelake: change-log analytics expressed as Spark DataFrame jobs.

Row-change events become one append-only change log; snapshots, live tables and
the log are then queried together.  Every public function takes and returns
DataFrames (or Columns) and leaves physical choices to Catalyst and AQE.
"""

__version__ = "0.1.0"
