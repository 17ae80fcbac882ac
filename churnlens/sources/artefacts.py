"""Versioned artefacts: what jobs publish together, readers see together (SNK3, SNK4).

A publication writes its parts (model, latent tables, ...) into a folder of its own, which nothing writes to
again, and then a manifest that names the folder of every part.  Parts that a publication does not bring
are taken over from the manifest before it.  The manifest is put in place by one rename that fails if
its number is taken, so a reader finds either the old set of parts or the new one, also while a job
writes, and after a job that was lost half-way.

    <root>/parts/<unique>/<part>/...      <root>/manifests/<number>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    """A published set: the folder of each part, and facts about them."""

    number: int
    parts: dict[str, str]
    facts: dict = field(default_factory=dict)


class Artefacts:
    """The artefacts under a folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        folder = self._path(f"{self.root}/manifests")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:08d}.json"

    def version(self, number: int) -> Version:
        stream = self._fs().open(self._path(self._manifest(number)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def current(self) -> Version | None:
        """The latest published version, or None before the first."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else None

    def publish(self, parts: dict[str, Callable[[str], object]], facts: dict | None = None) -> Version:
        """Calls each part's writer with its new folder, then publishes them as one version."""
        folder = f"{self.root}/parts/{uuid.uuid4().hex}"
        for name, write in parts.items():
            write(f"{folder}/{name}")
        while True:
            before = self.current() or Version(0, {})
            made = Version(before.number + 1, {**before.parts, **{n: f"{folder}/{n}" for n in parts}},
                           {**before.facts, **(facts or {})})
            if self._put(made):
                return made

    def _put(self, version: Version) -> bool:
        """Writes the manifest aside and renames it to its place; False if another job was first."""
        aside = self._path(f"{self.root}/manifests/{uuid.uuid4().hex}.tmp")
        out = self._fs().create(aside, False)
        out.write(bytearray(json.dumps({"number": version.number, "parts": version.parts, "facts": version.facts}).encode()))
        out.close()
        place = self._path(self._manifest(version.number))
        gateway = self.spark.sparkContext._gateway
        none = gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self._conf)
        try:
            context.rename(self._fs().makeQualified(aside), self._fs().makeQualified(place), none)
        except Exception as e:  # the JVM's exception arrives wrapped
            self._fs().delete(aside, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def table(self, name: str, version: Version | None = None) -> DataFrame | None:
        """A part written as parquet, of the given or the current version; None if it has none."""
        found = version or self.current()
        return self.spark.read.parquet(found.parts[name]) if found and name in found.parts else None

    def prune(self, keep: int = 2) -> list[int]:
        """Deletes manifests but the latest ``keep`` and the parts that none of those names; the numbers that went.

        To be run when no job is writing: parts that are not published yet count as unused."""
        numbers = self.numbers()
        gone, stay = numbers[:-keep] if keep else [], numbers[-keep:] if keep else numbers
        used = {p for n in stay for p in self.version(n).parts.values()}
        for n in gone:
            self._fs().delete(self._path(self._manifest(n)), False)
        folder = self._path(f"{self.root}/parts")
        if self._fs().exists(folder):
            for written in self._fs().listStatus(folder):
                name = f"{self.root}/parts/{written.getPath().getName()}"
                if not any(p.startswith(name + "/") for p in used):
                    self._fs().delete(written.getPath(), True)
        return gone
