"""A warehouse folder that is loaded repeatedly: every load is whole or not there, and no key is stored twice (R2.1).

Each load has an id and writes ``<table>/load=<id>`` for every table, parents before children. Rows whose key a committed load holds
already are left out by an anti join. Only when all tables are written, a marker with the row counts is published in one
step; readers take the folders that markers name. So a load that died half-way is invisible, repeating it under its id
replaces what it left behind, and repeating a committed one changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.files import exists, file_names, publish_text, read_text
from wardlens.sources.schemas import LOAD_ORDER, PRIMARY_KEYS

REPORT = "load_order int, table_name string, source_rows bigint, added_rows bigint, already_there bigint, stored_rows bigint"
Write = Callable[[DataFrame, str], None]


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


class LoadedWarehouse:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def _marker(self, load_id: str) -> str:
        return f"{self.directory}/_loads/{load_id}.json"

    def committed(self) -> dict[str, dict]:
        """The committed loads, oldest first, with their tables' rows."""
        folder = f"{self.directory}/_loads"
        names = [n for n in file_names(self.spark, folder) if n.endswith(".json")] if exists(self.spark, folder) else []
        found = [json.loads(read_text(self.spark, f"{folder}/{n}")) for n in names]
        return {m["load_id"]: m for m in sorted(found, key=lambda m: (m["number"], m["load_id"]))}

    def read(self, table: str) -> DataFrame | None:
        """The rows of all committed loads; none if no load has the table."""
        paths = [f"{self.directory}/{table}/load={i}" for i, m in self.committed().items() if table in m["tables"]]
        return self.spark.read.parquet(*paths) if paths else None

    def load(self, tables: Mapping[str, DataFrame], load_id: str, write: Write = write_parquet) -> DataFrame:
        """Add what is new of every table, and report per table the source's rows, the added ones and all that are stored.

        Rows of one load that share a key, or have none, are all written: that is for the contracts to judge.
        """
        done = self.committed()
        if load_id not in done:
            names = [n for n in LOAD_ORDER if n in tables] + [n for n in tables if n not in LOAD_ORDER]
            entries = {}
            for name in names:
                new, stored = tables[name], self.read(name)
                path = f"{self.directory}/{name}/load={load_id}"
                if stored is not None:
                    keys = list(PRIMARY_KEYS.get(name, tables[name].columns))
                    known = stored.select(*keys).withColumns({f"_{k}": F.col(k) for k in keys}).drop(*keys)
                    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
                    new = new.join(known, same, "left_anti")
                write(new, path)
                added = self.spark.read.schema(new.schema).parquet(path).count()
                # With nothing stored every row of the source was written: it is not made again to be counted.
                entries[name] = {"source": added if stored is None else tables[name].count(), "added": added}
            marker = {"load_id": load_id, "number": len(done), "tables": entries}
            publish_text(self.spark, self._marker(load_id), json.dumps(marker), uuid.uuid4().hex[:8])
            done = self.committed()
        rows = []
        for position, (name, counts) in enumerate(done[load_id]["tables"].items(), start=1):
            total = sum(m["tables"][name]["added"] for m in done.values() if name in m["tables"])
            rows.append((position, name, counts["source"], counts["added"], counts["source"] - counts["added"], total))
        return self.spark.createDataFrame(rows, REPORT)
