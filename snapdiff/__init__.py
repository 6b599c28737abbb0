"""Snapshot comparison and record quality on Spark."""

from .model import ConfigError, FeedSpec
from .plans.delta_job import DeltaResult, delta_of, run_delta, run_job
from .plans.feeds import FeedRun, run_feeds, run_workflow
from .session import build_session

__all__ = ["ConfigError", "DeltaResult", "FeedRun", "FeedSpec", "build_session", "delta_of", "run_delta",
           "run_feeds", "run_job", "run_workflow"]
