"""Corpus balancing and curation on Spark: profiles, allocation, quality rules, similarity and generation rounds as DataFrame plans."""

__version__ = "0.1.0"
