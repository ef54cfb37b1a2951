"""Municipal health analytics as Spark DataFrame jobs."""

from municare.session import build_session, shared_folder, size_shuffles

__all__ = ["build_session", "shared_folder", "size_shuffles"]
