from millrace.plans import cash, loyalty, pos, sales

__all__ = ["cash", "loyalty", "pos", "sales"]
