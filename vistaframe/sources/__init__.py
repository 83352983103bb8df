from .tables import TABLES, read_table, register_tables  # noqa: F401
