"""leafwright: Spark-native upkeep of large, multi-language documentation sites."""

__version__ = "0.1.0"
