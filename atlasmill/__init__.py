"""atlasmill: a Spark-native engine for point-of-interest layers and training-data tables."""

__version__ = "0.1.0"
