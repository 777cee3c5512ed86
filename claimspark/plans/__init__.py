"""Registered queries over the shared tables."""

from importlib import import_module

MODULES = ("q_claims", "q_visits", "q_drugs", "q_ops", "q_scripts")


def load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
