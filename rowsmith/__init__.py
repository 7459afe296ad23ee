"""rowsmith: table enrichment with model answers, as Spark DataFrame plans."""

__version__ = "0.1.0"
