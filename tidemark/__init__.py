"""Spark jobs for dated text and price series."""

from tidemark.session import build_session, shared_folder, staged

__all__ = ["build_session", "shared_folder", "staged"]
