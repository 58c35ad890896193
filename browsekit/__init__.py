"""browsekit: browse-and-remind analytics as Spark DataFrame jobs."""

from .config import RunWindow
from .session import build_session, configure

__all__ = ["RunWindow", "build_session", "configure"]
