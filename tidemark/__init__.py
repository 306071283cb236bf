"""Customer retention and revenue analytics, declared as Spark DataFrame plans."""

from tidemark.params import Params

__all__ = ["Params"]
