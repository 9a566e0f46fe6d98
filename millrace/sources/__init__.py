from millrace.sources import feeds, reports, tables

__all__ = ["feeds", "reports", "tables"]
