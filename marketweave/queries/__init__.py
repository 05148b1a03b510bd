"""Every query of the package, with the SQL that checks it."""

from . import (  # noqa: F401
    audits_q,
    joins_q,
    macro_q,
    maintenance_q,
    normalize_q,
    rankings_q,
    scalars_q,
    status_q,
    tables_q,
    windows_q,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
