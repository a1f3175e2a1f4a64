"""Raw log text to queryable tables on Spark, in batch and as a stream."""
