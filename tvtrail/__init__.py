"""Set-top-box log analytics written as PySpark DataFrame jobs."""
