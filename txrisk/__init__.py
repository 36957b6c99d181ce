"""Transaction-risk analytics on PySpark: batch and stream scoring, training, reports."""
