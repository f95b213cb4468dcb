"""Conform: build a governed mart on Spark from sources that disagree with each other."""

__version__ = "0.1.0"
