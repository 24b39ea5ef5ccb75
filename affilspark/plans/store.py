"""Tables of a run, each with a manifest: what has not changed is read, what has is computed again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from affilspark.sources.writers import write_ordered

#: To be raised when operators give other results from the same inputs.
RULES = 3


class Store:
    """A folder of tables. Each is written in an order, with its metrics gathered in that pass, and its manifest last.

    A table's fingerprint covers its name and schema, RULES, the run's constants and the fingerprints of what it needs: sources
    (names, sizes and times of their files) and other tables. A table whose manifest has the same fingerprint is
    read; a run that was cut off has no manifest for the table it was at, and starts there.
    """

    def __init__(self, spark: SparkSession, root: str, **constants: str):
        self.spark, self.root, self.constants = spark, root, constants
        self.marks: dict[str, str] = {}
        self.metrics: dict[str, dict] = {}
        self.made: list[str] = []

    def source(self, name: str, path: str | None) -> None:
        """Takes the files below a path as an input called name; hidden ones do not count."""
        if path is None:
            self.marks[name] = "none"
            return
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        seen = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        self.marks[name] = json.dumps(list(seen))

    def keep(self, df: DataFrame, name: str, needs: Sequence[str] = (), order: Sequence[Column | str] = (), metrics: dict[str, Column] | None = None, hidden: Sequence[str] = (), light: bool = False) -> DataFrame:
        """The table called name: as written if nothing it needs has changed, else df, written now.

        metrics are aggregates over df without distinct ones; `rows` is always among them. hidden columns serve
        metrics and are not written. (light is for keepers that do not write every table.)
        """
        shown = df.drop(*hidden)
        mark = hashlib.sha256(json.dumps([name, shown.schema.json(), RULES, self.constants, [[n, self.marks[n]] for n in needs]]).encode()).hexdigest()
        path = f"{self.root}/{name}"
        manifest = self._read(name)
        if manifest is None or manifest["fingerprint"] != mark:
            self._remove(name)
            seen = Observation(name.replace("/", "_"))
            wanted = {"rows": F.count(F.lit(1))} | (metrics or {})
            whole = (df.orderBy(*order) if order else df).observe(seen, *[c.alias(k) for k, c in wanted.items()]).drop(*hidden)
            write_ordered(whole.withColumns({k: F.lit(v) for k, v in self.constants.items()}), path)
            manifest = {"fingerprint": mark, "needs": list(needs), "schema": json.loads(shown.schema.json()), "metrics": seen.get}
            self._write(name, manifest)
            self.made.append(name)
        self.marks[name], self.metrics[name] = mark, manifest["metrics"]
        return self.spark.read.schema(shown.schema).parquet(path)

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_manifests/{name.replace('/', '.')}.json")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _read(self, name: str) -> dict | None:
        files, path = self._at(name)
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except (Py4JJavaError, ValueError):  # cut off while it was written
            return None
        finally:
            stream.close()

    def _write(self, name: str, manifest: dict) -> None:
        files, path = self._at(name)
        stream = files.create(path, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()

    def _remove(self, name: str) -> None:
        files, path = self._at(name)
        files.delete(path, False)
