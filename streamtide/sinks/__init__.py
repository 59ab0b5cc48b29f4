"""Writers and maintenance jobs."""
