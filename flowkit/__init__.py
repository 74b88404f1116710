"""flowkit: reusable PySpark operators for batch and streaming data work."""
