"""DataFrame operators: links, fields, languages, classes and records."""
