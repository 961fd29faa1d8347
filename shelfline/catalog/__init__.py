"""All named queries with their comparison SQL."""

from shelfline.catalog import core, eda, features, forecasting, loads, reports  # noqa: F401
from shelfline.catalog.base import REGISTRY, comparable  # noqa: F401
