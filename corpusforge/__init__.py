"""corpusforge: Spark-native curation of scholarly corpora and analysis of the queries written against them."""
