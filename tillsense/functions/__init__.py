from tillsense.functions.exprs import *  # noqa: F401,F403
from tillsense.functions.exprs import __all__  # noqa: F401
