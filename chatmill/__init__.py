"""chatmill: a PySpark engine that curates, analyses and audits conversational text corpora."""

__version__ = "0.1.0"
