from . import adapters  # noqa: F401
