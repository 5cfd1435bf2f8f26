"""DataFrame operators on microdata, metadata, aggregates and bins."""
