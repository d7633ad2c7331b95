"""newsloom: news curation on Spark."""
