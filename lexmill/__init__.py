"""lexmill: labelled-text analytics as Spark DataFrame jobs."""

from lexmill.session import get_session

__all__ = ["get_session"]
