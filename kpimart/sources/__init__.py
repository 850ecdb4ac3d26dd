"""Sources and sinks: scans with declared columns, mart sink, staging."""

from kpimart.sources.io import conform, read_mart, read_marts, read_source, stage, staged, unstage, write_mart
from kpimart.sources.manifest import expire_runs, read_manifest

__all__ = ["conform", "expire_runs", "read_manifest", "read_mart", "read_marts", "read_source", "stage", "staged", "unstage",
           "write_mart"]
