"""Card-fraud analytics on Spark: streaming rules, batch ETL, reports."""

from .config import DEFAULT, RuleConfig  # noqa: F401
