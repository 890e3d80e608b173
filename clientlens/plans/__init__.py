"""Fixture plans: one (spark, sf_dir) -> DataFrame function per analysis key,
and the matching oracle SQL."""

from clientlens.plans.registry import oracle_sql, queries  # noqa: F401
