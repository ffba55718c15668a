"""Spark-native analytics over yearly, schema-drifting education microdata."""
