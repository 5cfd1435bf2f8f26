"""The two pipelines: microdata to wide aggregates, wide aggregates to bins."""
