"""termloom: text-corpus statistics as Spark DataFrame jobs."""

from termloom.plans.index import TextIndex
from termloom.session import build_session

__all__ = ["TextIndex", "build_session"]
