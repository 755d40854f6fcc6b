"""Driver queries: each key runs one or more operators on the driver tables.

Importing the query modules registers their queries (and oracle SQL) in
:mod:`guestfold.plans.registry`.
"""

from . import q_batch, q_change, q_clean, q_hotel, q_identity, q_io, q_joins, q_keys, q_load, q_misc, q_stays  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
