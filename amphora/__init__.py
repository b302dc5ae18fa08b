"""amphora: DataFrame operators for antimicrobial-peptide screening on Spark."""

__version__ = "0.1.0"
