"""All named queries. Importing the modules registers them."""

from . import charts, cleaning, engineering, kernels, modelling, profiling, scoring, tables, trees  # noqa: F401
from ._registry import ORACLES, QUERIES  # noqa: F401
