"""Silver tables, gold marts, serving queries and batch jobs."""
