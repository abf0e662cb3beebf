"""Behavioural profiling, label priors and stacked scoring as Spark DataFrame jobs."""
