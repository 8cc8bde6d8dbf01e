"""Sets of tables that change from one version to the next in one step."""

from .manifest import Manifest, Part
from .tables import Store

__all__ = ["Manifest", "Part", "Store"]
