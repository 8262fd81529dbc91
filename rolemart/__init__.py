"""Role-level game analytics warehouse on Spark DataFrames."""

from rolemart.config import Game, RunWindow

__all__ = ["Game", "RunWindow"]
