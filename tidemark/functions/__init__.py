"""Column functions. Everything here is a plain expression, planned and compiled by Catalyst."""

from tidemark.functions.bands import *  # noqa: F401,F403
from tidemark.functions.dates import *  # noqa: F401,F403
from tidemark.functions.keys import *  # noqa: F401,F403
from tidemark.functions.numbers import *  # noqa: F401,F403
from tidemark.functions.text import *  # noqa: F401,F403
