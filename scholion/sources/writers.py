"""Writers for article records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.operators.reconcile import WIRE_COLUMNS, update_items

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def sink_articles_json(articles: DataFrame, path: str, form: str = "json") -> None:
    """Write all records, one per line (or as parquet)."""
    articles.write.mode("overwrite").format(form).save(path)


def sink_update_payload(articles: DataFrame, *keys: str) -> DataFrame:
    """Keys and ``json``: the wire record, without nulls, dates in ISO seconds."""
    record = F.to_json(F.struct(*WIRE_COLUMNS), {"timestampNTZFormat": ISO_SECONDS})
    return update_items(articles, *keys).select(*keys, "pmc_id", record.alias("json"))


def write_files(named: DataFrame, folder: str) -> None:
    """Write each row (name, content) as a file of its own into a shared folder."""

    def write_partition(rows) -> None:
        from pyarrow import fs

        if "://" in folder:
            system, root = fs.FileSystem.from_uri(folder)
        else:  # a plain path, or Hadoop's short form file:/path
            system, root = fs.LocalFileSystem(), folder.removeprefix("file:")
        system.create_dir(root, recursive=True)
        for row in rows:
            with system.open_output_stream(f"{root}/{row['name']}") as out:
                out.write(row["content"].encode("utf-8"))

    named.select("name", "content").foreachPartition(write_partition)
