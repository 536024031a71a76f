"""salesmart: a Spark-native warehouse for multi-store point-of-sale files."""
