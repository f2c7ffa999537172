"""Reading catalogues and writing derived tables."""

from marketlens.sources.json_arrays import json_array_texts, read_json_array
from marketlens.sources.json_catalogue import (
    CATALOGUE_SCHEMA,
    RECORD_SCHEMA,
    flatten_struct,
    read_catalogue,
)
from marketlens.sources.json_keys import audit_inferred_keys, json_texts
from marketlens.sources.named_tables import NamedTable
from marketlens.sources.tables import (
    describe_schema,
    literal_rows,
    discard,
    materialise,
    preview,
    row_count,
    shared_folder,
)

__all__ = [
    "CATALOGUE_SCHEMA",
    "NamedTable",
    "RECORD_SCHEMA",
    "audit_inferred_keys",
    "describe_schema",
    "flatten_struct",
    "json_array_texts",
    "json_texts",
    "literal_rows",
    "discard",
    "materialise",
    "preview",
    "read_catalogue",
    "read_json_array",
    "row_count",
    "shared_folder",
]
