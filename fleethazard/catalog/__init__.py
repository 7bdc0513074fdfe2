from fleethazard.catalog.base import ORACLES, QUERIES, RAW  # noqa: F401
from fleethazard.catalog import evaluation, tables, windows  # noqa: F401
from fleethazard.catalog import eda, models, quality, splits  # noqa: F401
