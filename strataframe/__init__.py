"""A Spark-native engine for archives of indexed images and the tables that describe them."""
