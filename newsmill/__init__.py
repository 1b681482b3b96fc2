"""Spark-native analytics for collections of articles, pages, events and transcripts."""

__version__ = "0.1.0"
