"""Column-level functions (survey 2.8 scalar functions)."""

from orrery.functions.columns import *  # noqa: F401,F403
