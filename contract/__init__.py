"""Driver contract: inputs derived from the given tables, registered queries and their SQL."""
