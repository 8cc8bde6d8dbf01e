"""Writers."""

from .tables import write_table

__all__ = ["write_table"]
