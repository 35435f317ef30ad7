"""What runs on Spark: the rules of the venues, their extraction plans and the query catalogue."""
