from . import snapshots  # noqa: F401
