"""Readers, writers and where intermediate tables go."""

from .cells import create_cells, merged_cells, upsert_cells
from .instances import read_instances, read_model, read_models, write_model
from .graph_text import read_adjacency
from .page_links import page_edges, page_nodes
from .segments import read_segments, read_skips, write_segments
from .sinks import write_index, write_keyed_table, write_text
from .state import bucketed, cut, release, state_dir
from .tables import TBL_SCHEMAS, read_tbl
from .text import read_lines, read_lines_with_offset

__all__ = [
    "TBL_SCHEMAS",
    "bucketed",
    "create_cells",
    "cut",
    "merged_cells",
    "page_edges",
    "page_nodes",
    "read_adjacency",
    "read_instances",
    "read_lines",
    "read_lines_with_offset",
    "read_model",
    "read_models",
    "read_segments",
    "read_skips",
    "read_tbl",
    "release",
    "state_dir",
    "upsert_cells",
    "write_index",
    "write_keyed_table",
    "write_model",
    "write_segments",
    "write_text",
]
