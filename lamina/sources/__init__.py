from lamina.sources.archives import entry_lines, expand_entries, list_entries
from lamina.sources.delimited import (
    detect_separators,
    file_heads,
    read_delimited,
    read_detected,
    read_landing,
    separators_by_agreement,
)
from lamina.sources.files import bytes_of, classify_archives, list_files, read_manifest, resolve_archives
from lamina.sources.tables import is_readable, read_first_available

__all__ = [
    "bytes_of",
    "classify_archives",
    "detect_separators",
    "entry_lines",
    "expand_entries",
    "file_heads",
    "is_readable",
    "list_entries",
    "list_files",
    "read_delimited",
    "read_detected",
    "read_first_available",
    "read_landing",
    "read_manifest",
    "resolve_archives",
    "separators_by_agreement",
]
