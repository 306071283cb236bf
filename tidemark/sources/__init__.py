"""Reading the model tables and writing the customer master."""

from tidemark.sources.tables import Tables

__all__ = ["Tables"]
