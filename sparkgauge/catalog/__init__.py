"""Registered queries: library operators bound to the given tables."""

import importlib

FAMILIES: tuple[str, ...] = ("normalisation", "filters", "joining", "shaping", "timeseries", "sourcing", "incremental", "collecting", "reporting", "checking")


def load_all() -> None:
    for name in FAMILIES:
        importlib.import_module(f"sparkgauge.catalog.{name}")
