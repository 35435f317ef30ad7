"""Reading pages and seeds, writing and reading the event store."""
