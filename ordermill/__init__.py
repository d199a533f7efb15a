"""ordermill: a Spark-native engine for order-intake data."""
