"""All registered queries. Importing the theme modules fills the tables."""

from . import aggs, backtest, features, joins, knn, models, streams, text, verbs, windows  # noqa: F401
from ._base import ORACLE, QUERIES  # noqa: F401
