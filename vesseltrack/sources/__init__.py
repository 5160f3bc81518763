"""Scans: daily position files, the sanctions bulk file, catalog tables, test adapters."""

from vesseltrack.sources.ais import NA_TOKENS, normalise_missing, read_ais, with_lineage
from vesseltrack.sources.sanctions import flatten_entities, parse_entity_lines, read_sanctions
from vesseltrack.sources.catalog import ingested_files, read_watermark, table_exists

__all__ = [
    "NA_TOKENS", "normalise_missing", "read_ais", "with_lineage",
    "flatten_entities", "parse_entity_lines", "read_sanctions",
    "ingested_files", "read_watermark", "table_exists",
]
