"""corpuskit: a PySpark-native engine for curating source-code and text corpora."""

__version__ = "0.1.0"
