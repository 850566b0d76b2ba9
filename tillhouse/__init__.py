"""Tillhouse: a Spark-native lakehouse engine for retail point-of-sale feeds."""
