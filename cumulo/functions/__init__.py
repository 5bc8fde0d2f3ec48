"""Column-level helpers (inventory section 2H), all built-in expressions."""

from cumulo.functions.columns import *  # noqa: F401,F403
