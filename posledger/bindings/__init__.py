"""Registered queries over the driver tables, with their SQL oracles."""

from importlib import import_module

MODULES = ("checks", "landed", "ledger", "market", "performance", "reports", "texts", "exports", "histories")


def load_all() -> None:
    for name in MODULES:
        import_module(f"posledger.bindings.{name}")
