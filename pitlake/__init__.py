"""Point-in-time equity and index market data on Spark."""

from pitlake.api import MarketLake
from pitlake.plans.sync import SyncFailed, SyncReport
from pitlake.session import build_session

__all__ = ["MarketLake", "SyncFailed", "SyncReport", "build_session"]
