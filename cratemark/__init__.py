"""Track categorisation as Spark jobs."""

from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import Tables, publish, refresh
from .sinks import write_table
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources
from .store import Store

__all__ = [*_operators, *_sources, "Store", "Tables", "publish", "refresh", "write_table"]
