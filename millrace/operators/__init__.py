from millrace.operators import audit, enrich, keys, ledger, lookup, merge, metrics, slices, totals

__all__ = ["audit", "enrich", "keys", "ledger", "lookup", "merge", "metrics", "slices", "totals"]
