"""Event-listing pages to clean bilingual event records, on Spark."""
