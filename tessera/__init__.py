"""tessera — a Spark-native engine for document-estate inventory and storage analytics."""

__version__ = "0.1.0"
