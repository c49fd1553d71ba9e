from bramble.sources.tables import Tables  # noqa: F401
from bramble.sources import fixtures, sinks  # noqa: F401
