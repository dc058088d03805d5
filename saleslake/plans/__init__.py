"""Multi-step jobs over the catalog: tables, staging, the table merge and the pipeline."""
