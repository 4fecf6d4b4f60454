"""fleetday: courier-day metrics on Spark."""

from fleetday.config import Config

__all__ = ["Config"]
