"""Imports every query module so that all queries are registered."""

from . import q_chunks, q_fields, q_jobs, q_manifest, q_met, q_release, q_store  # noqa: F401
