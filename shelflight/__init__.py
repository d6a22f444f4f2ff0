"""Product-catalogue analytics on Spark DataFrames."""

from shelflight.roles import Roles

__all__ = ["Roles"]
