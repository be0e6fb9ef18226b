"""Job-posting analytics on Spark: captured pages in, a clean postings table out."""
