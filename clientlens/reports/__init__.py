"""Runnable reports over a client-contact table (batch analyses, the
propensity model, partitioning, the streaming job)."""
