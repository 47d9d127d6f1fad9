"""Spark-native entity resolution and sector analytics over one noisy free-text name column."""
