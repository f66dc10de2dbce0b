"""Column-level helpers (scalar functions and predicates)."""

from .columns import *  # noqa: F401,F403
from .columns import KEEP  # noqa: F401
