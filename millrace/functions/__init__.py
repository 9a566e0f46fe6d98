from millrace.functions import columns, conform

__all__ = ["columns", "conform"]
