"""Imports every module that registers queries."""
from . import crosslingual  # noqa: F401
from . import narrative  # noqa: F401
from . import measures  # noqa: F401
from . import questions  # noqa: F401
from . import texts  # noqa: F401
from . import advanced  # noqa: F401
from . import more  # noqa: F401
from . import naming  # noqa: F401
from . import week  # noqa: F401
from . import audit  # noqa: F401
from . import network  # noqa: F401
from . import learned  # noqa: F401
