"""caseworks: support-programme analytics as plain PySpark DataFrame jobs."""
