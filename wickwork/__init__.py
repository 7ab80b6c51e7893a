"""wickwork: a Spark-native engine for candle time series and text corpora."""
