"""A Spark-native analytics engine for genetic association summary statistics."""
