"""Data-quality and ledger loads for dirty account files, as Spark DataFrame jobs."""

from ledgerq.config import RunConfig

__all__ = ["RunConfig"]
