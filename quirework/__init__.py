"""quirework: page layout blocks in, audited training corpora out, as Spark DataFrame plans."""

__version__ = "0.1.0"
