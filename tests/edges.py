"""Tables without rows, and tables whose rows hold nulls wherever a column may, for tests that run every query on them."""

import os

import pyarrow.parquet as pq
import pyarrow as pa

#: Columns that identify a row and are never null; all others become null.
IDS = {
    "olist": ["line_no"], "p2cd": ["list_id"], "store_idx": ["id", "off", "len", "sec", "sha"], "idx": ["idx_id"], "backfill": ["bf_id"], "p2tips": ["tip_id"], "urls": ["url_id"], "authors": ["author_id"], "documents": ["doc_id"],
    "mix_targets": ["source", "target_share", "max_repeats"], "pack_capacity": ["pack_id", "capacity_tokens"],
}


def write(source: str, target: str, kind: str) -> str:
    """The tables of `source` below `target`: `empty` without rows, `nulls` with every column but the ids null."""
    os.makedirs(target, exist_ok=True)
    for f in os.listdir(source):
        name = f.split(".")[0]
        t = pq.read_table(f"{source}/{f}")
        if kind == "empty":
            t = t.slice(0, 0) if name not in ("pack_capacity", "mix_targets") else t
        elif name in IDS:
            t = t.slice(0, 40)
            t = pa.table({c: t[c] if c in IDS[name] else pa.nulls(t.num_rows, t.schema.field(c).type) for c in t.column_names})
        pq.write_table(t, f"{target}/{name}.parquet")
    return target
