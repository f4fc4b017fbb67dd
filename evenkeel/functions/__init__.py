"""Column expressions: every function takes and returns a ``Column``."""

from evenkeel.functions.bands import *  # noqa: F401,F403
from evenkeel.functions.numbers import *  # noqa: F401,F403
from evenkeel.functions.text import *  # noqa: F401,F403
from evenkeel.functions.times import *  # noqa: F401,F403
