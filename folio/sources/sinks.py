"""Where results go: a Parquet table of items, and one Markdown file for each item.

The table is the store; files are an export of it. A file's name is fixed by its item, so a repeated task writes the
same file again. Files are written under a temporary name and then renamed."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from folio.functions import fixed as K


def rendered(metadata: dict, body: str) -> str:
    import yaml

    front = yaml.safe_dump(metadata, allow_unicode=True, sort_keys=False, default_flow_style=False).strip()
    return f"---\n{front}\n---\n\n{body.strip()}\n"


def _plain(x):
    if isinstance(x, Row):
        return {k: _plain(v) for k, v in x.asDict().items()}
    return [_plain(v) for v in x] if isinstance(x, list) else x


def _put(folder: str, name: str, text: str) -> None:
    at = os.path.join(folder, name)
    part = f"{at}.{os.getpid()}.part"
    with open(part, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(part, at)


def write_files(items: DataFrame, folder: str) -> None:
    """One file for each item in a folder that all workers share."""
    os.makedirs(folder, exist_ok=True)

    def put(rows: Iterator[Row]) -> None:
        for r in rows:
            _put(folder, r.file_name, rendered({k: _plain(r[k]) for k in K.ITEM_FIELDS}, r.body))

    items.select("file_name", "body", *K.ITEM_FIELDS).foreachPartition(put)


def write_parsed(docs: DataFrame, folder: str) -> None:
    """The Markdown of each document; of documents with one stem the last stays."""
    os.makedirs(folder, exist_ok=True)
    last = docs.groupBy("stem").agg(F.max_by("markdown", "file_index").alias("markdown"))

    def put(rows: Iterator[Row]) -> None:
        for r in rows:
            _put(folder, f"{r.stem}.parsed.md", r.markdown)

    last.foreachPartition(put)


def write_table(items: DataFrame, path: str, mode: str = "append") -> None:
    items.write.mode(mode).partitionBy("review_status").parquet(path)
