"""Tables that are written once per application and then read by many queries."""

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from uptake.sources.shared import fresh_folder, remove
from uptake.sources.tables import conform, read_parquet, stored_schemas_of, write_by_month, write_table


class Store:
    """Writes a table on its first use and hands out readers afterwards.

    The written copy survives the loss of executors, gives Catalyst true file
    sizes, and lets a filter on ``month`` prune partitions. The store owns its copies: ``drop`` deletes one, ``close`` (or the
    end of a ``with`` block) all; frames that read them can't run after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._written: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def table(
        self, name: str, make: Callable[[], DataFrame], schema: StructType, by_month: bool = False
    ) -> DataFrame:
        """The table ``name``, written now if this is its first use. Safe to call from several threads."""
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self._written:
                path = fresh_folder(self.spark, name)
                df = conform(make(), schema)
                if by_month:
                    write_by_month(df, path)
                else:
                    write_table(df, path)
                self._paths[name] = path
                self._written[name] = read_parquet(self.spark, path, schema)
            return self._written[name]

    def stored(self, names: Iterable[str]) -> dict[str, list[StructType]]:
        """The schemas of written tables' files."""
        return stored_schemas_of(self.spark, {name: self._paths[name] for name in names})

    def has(self, *names: str) -> bool:
        """Whether all these tables are written."""
        return all(name in self._written for name in names)

    def drop(self, name: str) -> None:
        """Deletes a table's copy, if there is one; a later ``table`` writes it anew."""
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if self._written.pop(name, None) is not None:
                remove(self.spark, self._paths.pop(name))

    def close(self) -> None:
        for name in list(self._written):
            self.drop(name)

    def __enter__(self) -> "Store":
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
