"""Jobs: the load-rate mart (DataFrame and SQL-step forms), SQL view steps,
the stand-in inputs derived from the test tables, and the query catalogue."""
