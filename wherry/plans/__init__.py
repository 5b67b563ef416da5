"""The registered queries: importing the package imports every module of them."""

from importlib import import_module

from wherry.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

for _module in ("relational", "aggregates", "sessions", "attribution", "channels", "identity", "versions", "payments", "marts", "rules", "incremental"):
    import_module(f"wherry.plans.{_module}")
