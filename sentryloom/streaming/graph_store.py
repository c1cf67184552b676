"""A property graph on disk that batches are merged into: hash partitions, copied where touched, under a manifest.

``nodes`` and ``edges`` lie in ``partitions`` hash partitions each.  A batch reads and writes
only the partitions that its rows fall into, into a folder of its own; then a manifest names
for every partition the folder that holds it.  Manifests are numbered; one is written under
another name and renamed, so readers see the graph before the batch or after it, and of two
writers at a time one fails.  It carries the id of the last batch of every source: a batch
that runs again finds its id and changes nothing.  Folders that no manifest names any more
are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = 64
#: Manifests that stay, so that a reader of the one before can finish.
KEPT = 2
NODE_KEY, EDGE_KEY = ("id", "label"), ("source_id", "target_id", "type")
NODES = "id string, label string, properties map<string,string>, versions map<string,long>, _part int"
EDGES = "source_id string, target_id string, type string, _part int"


class Files:
    """The few file operations on the table's folder that Spark's readers and writers do not offer, by Hadoop paths."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm, self.folder = spark._jvm, folder
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str) -> list[str]:
        at = self._path(name)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: written under another name and renamed."""
        other = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(other), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(self._path(other), self._path(name)):
            raise OSError(f"{name} is there already: another writer was faster")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _part(keys: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(partitions)).cast("int")


def _manifests(files: Files) -> list[str]:
    return [x for x in files.names("manifests") if x.endswith(".json")]


def manifest(spark: SparkSession, folder: str) -> dict | None:
    """The newest manifest: ``number, batches`` (last id by source) ``, partitions, nodes`` and ``edges`` (folder of each partition)."""
    files = Files(spark, folder)
    names = _manifests(files)
    return json.loads(files.read(f"manifests/{names[-1]}")) if names else None


def _read(spark: SparkSession, folder: str, places: dict[str, str], schema: str) -> DataFrame:
    """The rows of the partitions, given as partition to folder."""
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/data").parquet(*[f"{folder}/data/{at}/_part={p}" for p, at in sorted(places.items())]).drop("_of").select(*[x.split(" ")[0] for x in schema.split(", ")])


def merge_into(folder: str, nodes: DataFrame, edges: DataFrame, batch_id: int, partitions: int = PARTITIONS, source: str = "") -> bool:
    """Merges a batch's ``id, label, properties`` nodes and ``source_id, target_id, type`` edges; false if it is there already.

    The batch ids of a ``source`` (a stream's checkpoint) only grow.  A property set more than
    once keeps the value of the batch merged last (within a batch the largest); a null value changes nothing.  Edges are there once.
    Repeated rows count once; null ids are a key.  ``partitions`` holds for a new graph; an
    old one keeps its number.
    """
    spark = nodes.sparkSession
    files, old = Files(spark, folder), manifest(spark, folder)
    old = old or {"number": -1, "batches": {}, "partitions": partitions, "nodes": {}, "edges": {}}
    if batch_id <= old["batches"].get(source, -1):
        return False
    n, number = old["partitions"], old["number"] + 1
    of_batch = f"_of=m{number}-{uuid.uuid4().hex}"
    new = {"number": number, "batches": {**old["batches"], source: batch_id}, "partitions": n, "nodes": dict(old["nodes"]), "edges": dict(old["edges"])}
    for name, key, rows, schema in (("nodes", NODE_KEY, nodes, NODES), ("edges", EDGE_KEY, edges, EDGES)):
        rows = rows.select(*[c for c in (*key, "properties") if c in rows.columns]).withColumn("_part", _part(key, n)).persist()
        try:
            touched = [str(r[0]) for r in rows.select("_part").distinct().collect()]  # at most ``partitions``
            if touched:
                there = _read(spark, folder, {p: at for p, at in new[name].items() if p in touched}, schema)
                merged = _merged_nodes(there, rows, number) if name == "nodes" else there.unionByName(rows).distinct()
                merged.repartition(len(touched), "_part").write.partitionBy("_part").parquet(f"{folder}/data/{of_batch}-{name}")
                new[name] |= dict.fromkeys(touched, f"{of_batch}-{name}")
        finally:
            rows.unpersist()
    files.write(f"manifests/{number:020d}.json", json.dumps(new))
    _sweep(files)
    return True


def _merged_nodes(there: DataFrame, rows: DataFrame, number: int) -> DataFrame:
    """One row a node; of each property the value of the latest batch."""
    known = there.select(*NODE_KEY, "_part", F.explode_outer("properties").alias("k", "v"), "versions").withColumn("at", F.element_at("versions", F.col("k"))).drop("versions")
    fresh = rows.select(*NODE_KEY, "_part", F.explode_outer("properties").alias("k", "v")).withColumn("at", F.lit(number).cast("long"))
    each = known.unionByName(fresh)
    each = each.withColumn("k", F.when(F.col("v").isNotNull(), F.col("k")))
    last = each.groupBy(*NODE_KEY, "_part", "k").agg(F.max(F.struct("at", "v")).alias("_l"))
    entries = F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", F.col("_l.v").alias("v"), F.col("_l.at").alias("at")))))
    out = last.groupBy(*NODE_KEY, "_part").agg(entries.alias("_e"))
    pairs = lambda c: F.map_from_entries(F.transform("_e", lambda x: F.struct(x["k"], x[c])))
    return out.select(*NODE_KEY, pairs("v").alias("properties"), pairs("at").alias("versions"), "_part")


def _sweep(files: Files) -> None:
    """Removes manifests before the last ``KEPT`` and data folders that the others do not name."""
    names = _manifests(files)
    for name in names[:-KEPT]:
        files.delete(f"manifests/{name}")
    used = {at for name in names[-KEPT:] for kind in ("nodes", "edges") for at in json.loads(files.read(f"manifests/{name}"))[kind].values()}
    for name in files.names("data"):
        if name not in used:
            files.delete(f"data/{name}")


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes ``id, label, properties`` and edges ``source_id, target_id, type`` as the newest manifest gives them."""
    now = manifest(spark, folder) or {"nodes": {}, "edges": {}}
    nodes = _read(spark, folder, now["nodes"], NODES).drop("versions", "_part")
    return nodes, _read(spark, folder, now["edges"], EDGES).drop("_part")
