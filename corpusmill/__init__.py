"""corpusmill: a Spark-native engine for building, cleaning and auditing labelled text corpora."""
