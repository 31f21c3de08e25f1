"""Star-schema warehouse for articles: incremental loads, upserts and delete reconciliation on Spark."""
