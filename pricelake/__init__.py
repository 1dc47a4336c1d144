"""Price-feed lakehouse jobs on Spark: raw JSON landing, silver tables, gold marts, publication."""
