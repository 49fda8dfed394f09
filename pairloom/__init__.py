"""pairloom: a Spark-native engine for labelled pair datasets."""
