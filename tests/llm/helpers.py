"""Fixture tables written as Parquet folders the queries can read."""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()),
                  ("source", pa.string()), ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
BENCH = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
CONV = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
VECS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
SCHEMAS = {"documents": DOCS, "labels": LABELS, "benchmark": BENCH, "conversations": CONV,
           "embeddings": VECS, "pages": PAGES}


def docs_rows(pairs) -> list[tuple]:
    """(id, text) or (id, text, lang) -> rows of documents."""
    return [(p[0], p[1], p[2] if len(p) > 2 else "en", "s", len(p[1]) if p[1] is not None else None)
            for p in pairs]


def write_tables(**tables) -> str:
    """A folder with the named tables (lists of tuples); missing ones are empty."""
    root = tempfile.mkdtemp(prefix="run-llm-")
    for name, schema in SCHEMAS.items():
        rows = tables.get(name, [])
        cols = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(schema)]
        pq.write_table(pa.table(cols, schema=schema), os.path.join(root, f"{name}.parquet"))
    return root


def read_pairs(sf_dir: str, name: str = "documents", key: str = "doc_id") -> list[tuple]:
    t = pq.read_table(f"{sf_dir}/{name}.parquet", columns=[key, "text"])
    return list(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))


def rows_of(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
