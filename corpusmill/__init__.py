"""corpusmill: a Spark-native engine for building, cleaning, deduplicating and measuring text corpora."""
