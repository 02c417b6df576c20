"""metrolith: Spark-native operators for urban-mobility data."""
