"""Scalar column functions (F rows of the inventory)."""
from regpanel.functions.exprs import *  # noqa: F401,F403
from regpanel.functions.text import *  # noqa: F401,F403
from regpanel.functions.dates import *  # noqa: F401,F403
