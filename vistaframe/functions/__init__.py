from . import scalars  # noqa: F401
