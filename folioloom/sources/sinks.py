"""Writers. Each writes distributed, but for reports, whose rows are bounded."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_texts(docs: DataFrame, path: str) -> None:
    """One folder a year of extracted texts."""
    docs.select("year", "text").write.mode("overwrite").partitionBy("year").option("lineSep", "\n").text(path)


def write_records(records: DataFrame, path: str) -> None:
    """Records as JSON lines, non-ASCII characters kept."""
    records.write.mode("overwrite").json(path)


def write_entries(entry_rows: DataFrame, path: str, title: str = "Bibliography", pos: str = "ingest_pos") -> None:
    """Entries in order of (year, entry_id) in one sorted set of files behind a
    header; the year range in it is that of the entries."""
    total = entry_rows.agg(F.count("*").alias("n"), F.min("year").alias("a"), F.max("year").alias("b")).first()
    spark = entry_rows.sparkSession
    head = spark.createDataFrame([(f"% {title}, {total['a']}–{total['b']}\n% Total entries: {total['n']}\n",)], "entry string")
    head.coalesce(1).write.mode("overwrite").text(f"{path}/0-header")
    entry_rows.orderBy("year", "entry_id", pos).select("entry").write.mode("overwrite").text(f"{path}/1-entries")


def append_changes(changes: DataFrame, path: str, batch: str, today: str = "") -> None:
    """Appends a batch to the change log as JSON lines under a comment that names it.

    Batches are numbered in the order they are written, which is the order of
    their folders and so of the log's lines; a batch written twice keeps its
    place and replaces itself. Within a batch lines keep the order of ``changes``.
    """
    spark = changes.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    numbers = {n.split(".", 1)[1]: int(n[len("batch=") :].split(".", 1)[0]) for n in names if n.startswith("batch=") and "." in n}
    place = numbers.get(batch, 1 + max(numbers.values(), default=0))
    head = spark.createDataFrame([(f"# batch {batch} {today}".strip(),)], "value string").coalesce(1)
    lines = changes.select(F.to_json(F.struct(*changes.columns)).alias("value"))
    head.unionByName(lines).write.mode("overwrite").text(f"{path}/batch={place:08d}.{batch}")


def preview_changes(changes: DataFrame, path: str) -> None:
    """Patches and adds before deletes, each by (year, entry_id)."""
    changes.orderBy(F.col("op") == "delete", "year", "entry_id").write.mode("overwrite").json(path)


def upsert_sheet(rows: DataFrame, path: str) -> None:
    """Overwrites the sheets of the years at hand and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def report(title: str, tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A Markdown report of small result tables; each is limited, as a report is."""
    out = [f"# {title}\n"]
    for name, df in tables.items():
        got = df.limit(rows + 1).collect()
        out += [f"\n## {name}\n", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in got[:rows]]
        if len(got) > rows:
            out.append(f"\n_(first {rows} rows)_")
    return "\n".join(out) + "\n"


def with_retry(write: Callable[[], None], is_quota: Callable[[Exception], bool], tries: int = 5, wait: float = 45.0, sleep: Callable[[float], None] = time.sleep) -> None:
    """Runs a write against a service with a quota: waits longer after each quota error, raises any other."""
    for n in range(1, tries + 1):
        try:
            return write()
        except Exception as e:
            if not is_quota(e) or n == tries:
                raise
            sleep(wait * n)
