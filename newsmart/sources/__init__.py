"""Scans: feed archives, manifests, marts."""

from .archives import archive_glob, list_archives, read_archive_lines, scan_archives, unreadable_archives
from .manifest import read_manifest, select_period, union_manifests
from .marts import read_mart

__all__ = [
    "archive_glob", "list_archives", "read_archive_lines", "read_manifest", "read_mart", "scan_archives", "select_period",
    "union_manifests", "unreadable_archives",
]
