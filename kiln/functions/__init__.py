"""Column -> Column scalar functions (strings, numerics, arrays)."""
from kiln.functions import arrays, numeric, strings  # noqa: F401
