"""Platform-telemetry analytics as DataFrame jobs.

The package turns a data platform's own system tables into uniform telemetry
rows (four map sections per row), keeps incremental state, fans rows out into
metrics, logs, events and spans, and answers cost, performance, quality,
security and operations questions over them.
"""

from sparkgauge.session import configure

__all__ = ["configure"]
