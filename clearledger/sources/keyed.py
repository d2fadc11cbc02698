"""A table in parts by the hash of a key, of which only the parts that change are rewritten."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearledger.operators.reshape import field
from clearledger.sources.switch import drop_folder, read_text, subfolders, switch_text

_PART = "key_part"


@dataclass(frozen=True)
class KeyedTable:
    """Rows below ``base`` in ``n_parts`` parts. Each change writes its parts to a folder of its own, then
    switches the one file that says which folder holds which part. So a change that fails leaves
    the table as it was, and files of other parts are not touched. One writer at a time."""

    base: str
    keys: tuple[str, ...]
    n_parts: int = 64

    @property
    def _index(self) -> str:
        return f"{self.base}/index.json"

    def _state(self, spark: SparkSession) -> dict:
        text = read_text(spark, self._index)
        state = json.loads(text) if text else {"n_parts": self.n_parts, "schema": None, "parts": {}}
        if state["n_parts"] != self.n_parts:
            raise ValueError(f"{self.base} has {state['n_parts']} parts, not {self.n_parts}")
        return state

    def files(self, spark: SparkSession) -> dict[int, str]:
        """Folder of each part that has rows."""
        return {int(k): f"{self.base}/{v}/{_PART}={k}" for k, v in self._state(spark)["parts"].items()}

    def read(self, spark: SparkSession, parts: Iterable[int] | None = None) -> DataFrame:
        """All rows, or those of some parts; only the folders of these are listed and read."""
        state, folders = self._state(spark), self.files(spark)
        if state["schema"] is None:
            raise ValueError(f"nothing was written to {self.base}")
        schema = StructType.fromJson(state["schema"])
        chosen = [folders[p] for p in sorted(folders if parts is None else set(parts) & set(folders))]
        return spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)

    def _with_part(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_PART, F.pmod(F.xxhash64(*map(field, self.keys)), F.lit(self.n_parts)).cast("int"))

    def parts_of(self, rows: DataFrame) -> list[int]:
        """The parts that the keys of ``rows`` fall into, ``n_parts`` numbers at most."""
        return sorted(r[0] for r in self._with_part(rows).select(_PART).distinct().collect())

    def merge(self, spark: SparkSession, rows: DataFrame, reduce_: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Put ``reduce_`` of the old and new rows of each part that new rows fall into.

        ``reduce_`` must give for two batches, one after the other, what it gives for both at once. The parts that
        were rewritten are returned.
        """
        parts = self.parts_of(rows)
        if self._state(spark)["schema"] is not None:
            rows = self.read(spark, parts).unionByName(rows)
        self.replace(spark, reduce_(rows), parts)
        return parts

    def replace(self, spark: SparkSession, rows: DataFrame, parts: Sequence[int]) -> None:
        """Write ``rows``, which are all rows of ``parts``, in place of what these parts had."""
        state = self._state(spark)
        version = f"v-{uuid.uuid4().hex}"
        self._with_part(rows).repartition(_PART).write.partitionBy(_PART).parquet(f"{self.base}/{version}")
        written = {n.split("=")[1] for n in subfolders(spark, f"{self.base}/{version}")}
        if foreign := {int(p) for p in written} - set(parts):
            raise ValueError(f"rows of other parts than those replaced: {sorted(foreign)}")
        kept = {k: v for k, v in state["parts"].items() if int(k) not in parts}
        state |= {"schema": rows.schema.jsonValue(), "parts": kept | dict.fromkeys(sorted(written), version)}
        switch_text(spark, self._index, json.dumps(state))

    def prune(self, spark: SparkSession) -> None:
        """Delete what no part refers to: older versions, and those of changes that failed. Not while others read them."""
        live = self.files(spark)
        for version in subfolders(spark, self.base):
            held = {f for f in live.values() if f.startswith(f"{self.base}/{version}/")}
            if not held:
                drop_folder(spark, f"{self.base}/{version}")
                continue
            for part in subfolders(spark, f"{self.base}/{version}"):
                if f"{self.base}/{version}/{part}" not in held:
                    drop_folder(spark, f"{self.base}/{version}/{part}")
