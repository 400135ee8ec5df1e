"""DataFrame operators: column resolution, deduplication, upsert, lookups, aggregates, profiles."""
