"""An append-only store of immutable shards with size-tiered compaction.

Every arrival becomes small Parquet shards. Compaction puts shards of one size
tier (powers of ``FAN``) together to files of about the target size; a tier with
too little in it, and shards near the target, are left alone, so a row is
rewritten once a tier. One job merges all files of a tier: Spark packs them into
scan tasks of the target size, and each task writes one file, without a shuffle.

What a reader sees is a manifest: a small numbered JSON file that names parts,
which name up to ``PART_SHARDS`` shards each; a commit writes the parts that
changed. A version is claimed by creating a file that must not exist, then
published by one rename. Writers that race get a ``Conflict``; readers see whole
versions only; files of a failed or repeated task that no manifest names are
nobody's shards. The claim of a writer that died is taken over once it is older
than ``claim_seconds``, by renaming it away, which one writer alone can do. This
asks for a file system with exclusive creation and atomic renames (HDFS, local
and shared POSIX folders); an object store needs a committer of its own.

Nulls and repeated rows are kept; columns are kept in the order of the first
arrival, and an arrival without them is refused. An empty arrival adds no
shard and a version. An empty store reads as an empty table.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TARGET_BYTES = 64 << 20
FAN = 4
PART_SHARDS = 5000
CLAIM_SECONDS = 900
#: Files that the driver looks up itself.
LISTED_BY_DRIVER = 2000


@dataclass(frozen=True)
class Shard:
    path: str
    size: int


def tier_of(size: int, fan: int = FAN) -> int:
    tier = 0
    while size >= fan:
        size //= fan
        tier += 1
    return tier


def tiers(shards: list[Shard], target: int, fan: int = FAN) -> list[list[Shard]]:
    """What is worth merging: of each tier, its shards of up to half the target (any two of which fit a file, so that a merge leaves fewer), where they are as many as the fan, or fill half a file."""
    by: dict[int, list[Shard]] = {}
    for s in shards:
        if s.size <= target // 2:
            by.setdefault(tier_of(s.size, fan), []).append(s)
    found = [sorted(by[t], key=lambda x: (x.size, x.path)) for t in sorted(by)]
    return [r for r in found if len(r) >= fan or len(r) > 1 and sum(s.size for s in r) >= target // 2]


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str, claim_seconds: float = CLAIM_SECONDS):
        self.spark, self.path, self.claim_seconds = spark, path.rstrip("/"), claim_seconds
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._hadoop.Path(path)

    def _read(self, path: str):
        stream = self.fs.open(self._at(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, path: str, body) -> None:
        out = self.fs.create(self._at(path), True)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()

    def _names(self, folder: str) -> list[str]:
        at = self._at(f"{self.path}/{folder}")
        return [f.getPath().getName() for f in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names("manifest") if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known and version is None:
            return {"version": 0, "schema": None, "parts": []}
        return self._read(f"{self.path}/manifest/v{known[-1] if version is None else version:09d}.json")

    def _part(self, name: str) -> list[Shard]:
        return [Shard(f"{self.path}/{file}", size) for file, size in self._read(f"{self.path}/parts/{name}")]

    def shards(self, version: int | None = None) -> list[Shard]:
        return [s for part in self.manifest(version)["parts"] for s in self._part(part["name"])]

    def _parts(self, base: dict, gone: set[str], made: list[Shard]) -> list[dict]:
        """Parts of the next version: those that lose nothing and are well filled stay as they are."""
        kept, loose = [], []
        for part in base["parts"]:
            own = self._part(part["name"]) if gone or part["shards"] < PART_SHARDS // 2 else None
            if own is None or part["shards"] >= PART_SHARDS // 2 and not any(s.path in gone for s in own):
                kept.append(part)
            else:
                loose += [s for s in own if s.path not in gone]
        loose += made
        for at in range(0, len(loose), PART_SHARDS):
            piece = loose[at : at + PART_SHARDS]
            name = f"{uuid.uuid4().hex}.json"
            self._put(f"{self.path}/parts/{name}", [[s.path.removeprefix(self.path + "/"), s.size] for s in piece])
            kept.append({"name": name, "shards": len(piece)})
        return kept

    def _claim(self, name: str, token: str) -> None:
        """Create the claim of a version; one whose writer has been silent for too long is put aside first."""
        claim = self._at(name + ".claim")
        if self.fs.exists(self._at(name + ".json")):
            raise Conflict(f"{name} is taken")
        if self.fs.exists(claim):
            age = time.time() - self.fs.getFileStatus(claim).getModificationTime() / 1000
            if age > self.claim_seconds:
                self.fs.rename(claim, self._at(f"{name}.{token}.stale"))
        try:
            out = self.fs.create(claim, False)
        except Exception as e:  # the JVM's error for a file that exists
            raise Conflict(f"{name} is taken") from e
        out.write(bytearray(token.encode()))
        out.close()

    def commit(self, base: dict, schema: str, made: list[Shard], gone: set[str] = frozenset()) -> int:
        version, token = base["version"] + 1, uuid.uuid4().hex
        name = f"{self.path}/manifest/v{version:09d}"
        self._claim(name, token)
        body = {"version": version, "schema": schema, "parts": self._parts(base, gone, made)}
        self._put(f"{name}.{token}.part", body)
        stream = self.fs.open(self._at(name + ".claim"))
        try:
            mine = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") == token
        finally:
            stream.close()
        if not mine or self.fs.exists(self._at(name + ".json")) or not self.fs.rename(self._at(f"{name}.{token}.part"), self._at(name + ".json")):
            raise Conflict(f"version {version} was published by another writer")
        return version

    def _write(self, df: DataFrame) -> list[Shard]:
        """Files that a job committed; each has rows."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return [Shard(f"{folder}/{f.getPath().getName()}", f.getLen()) for f in self.fs.listStatus(self._at(folder)) if f.getPath().getName().startswith("part-")]

    def append(self, df: DataFrame) -> int:
        base = self.manifest()
        if base["schema"] is not None:
            df = df.select(*T.StructType.fromJson(json.loads(base["schema"])).names)
        return self.commit(base, base["schema"] or df.schema.json(), self._write(df))

    @contextmanager
    def _session(self, **conf: str):
        """Settings for as long as the block lasts."""
        conf = {f"spark.sql.{k.replace('_', '.')}": v for k, v in conf.items()}
        before = {k: self.spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            self.spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def _open(self, schema: T.StructType, shards: list[Shard]) -> DataFrame:
        """Shards as a frame; a job of its own to look up the files pays only for very many."""
        with self._session(sources_parallelPartitionDiscovery_threshold=str(LISTED_BY_DRIVER)):
            return self.spark.read.schema(schema).parquet(*[s.path for s in shards])

    def compact(self, target: int = TARGET_BYTES, fan: int = FAN) -> int:
        """One pass over all tiers; the version does not change where nothing is worth merging."""
        base = self.manifest()
        runs = tiers(self.shards(), target, fan)
        if not runs:
            return base["version"]
        schema = T.StructType.fromJson(json.loads(base["schema"]))
        made: list[Shard] = []
        # scan tasks take whole files up to the target together
        with self._session(files_maxPartitionBytes=str(target), files_openCostInBytes="0", files_minPartitionNum="1"):
            for run in runs:
                # any two of them fit a file, so this is fewer files than shards whatever the scan's own packing is
                made += self._write(self._open(schema, run).coalesce(-(-sum(s.size for s in run) // target)))
        return self.commit(base, base["schema"], made, {s.path for run in runs for s in run})

    def vacuum(self, keep: int = 1) -> int:
        """Delete files that none of the latest versions names, older manifests, and what dead writers left. Not beside a running writer."""
        known = self.versions()
        named = {s.path for v in known[-keep:] for s in self.shards(v)}
        parts = {p["name"] for v in known[-keep:] for p in self.manifest(v)["parts"]}
        n = 0
        for folder in self._names("data"):
            files = [f"{self.path}/data/{folder}/{f}" for f in self._names(f"data/{folder}")]
            dead = [f for f in files if f not in named]
            if len(dead) == len(files):
                dead = [f"{self.path}/data/{folder}"]
            n += sum(bool(self.fs.delete(self._at(f), True)) for f in dead)
        for f in self._names("parts"):
            if f not in parts:
                self.fs.delete(self._at(f"{self.path}/parts/{f}"), False)
        live = {f"v{v:09d}.json" for v in known[-keep:]}
        for f in self._names("manifest"):
            if f not in live:
                self.fs.delete(self._at(f"{self.path}/manifest/{f}"), False)
        return n

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if m["schema"] is None:
            return self.spark.createDataFrame([], T.StructType())
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        shards = self.shards(version)
        return self._open(schema, shards) if shards else self.spark.createDataFrame([], schema)
