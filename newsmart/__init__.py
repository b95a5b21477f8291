"""News-event analytics on Spark: feed archives in, query-ready marts out.

Every public function takes and returns DataFrames or Columns; the caller owns the session, and nothing in the
library collects rows to the driver.
"""
