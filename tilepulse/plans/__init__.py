"""Plans: the daily job, its multi-date form, and the registered queries."""
