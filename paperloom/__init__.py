"""paperloom: a document-corpus mapping engine written as Spark DataFrame operators."""

__version__ = "0.1.0"
