"""Reports on published tables, the load of a run, and the checked queries."""
