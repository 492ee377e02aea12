"""Column expressions: no UDFs, everything stays inside whole-stage codegen."""

from .dates import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
