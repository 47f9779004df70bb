"""concord: reconcile, audit and inventory migrated tables with Spark.

Every public function takes and returns DataFrames. Work runs on the
cluster; only bounded reports (verdicts, a changed-count, one boolean per
column) ever reach the driver.
"""

__version__ = "0.1.0"
