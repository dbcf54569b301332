"""Registered checks: each query with the SQL that must give the same rows."""

from registry import batch, edges, models, runs, streams


def all_checks():
    return [batch.checks, runs.checks, streams.checks, models.checks, edges.checks]
