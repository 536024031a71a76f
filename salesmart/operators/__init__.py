"""DataFrame-to-DataFrame steps: ids, lookups, dimensions, staging, validate, load."""
