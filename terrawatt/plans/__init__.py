"""Ready-made plans: derived datasets, marts and the query catalogue."""
