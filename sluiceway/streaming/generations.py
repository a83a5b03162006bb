"""A table that a stream adds to batch by batch, kept in immutable folders that a manifest lists.

A batch writes a folder of its own and then publishes a new manifest that names it; readers follow the newest manifest, so they
see a batch wholly or not at all. Each folder covers a range of batches. A batch that the ranges cover already is a replay and
adds nothing, before compaction as after it. ``fan`` folders of one level are merged into one of the next, so a table of n
batches has about fan * log(n) folders, and each row is rewritten log(n) times.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """A folder with the rows of the batches ``first`` to ``last``; ``low`` and ``high`` bound its times in microseconds."""

    folder: str
    first: int
    last: int
    level: int = 0
    low: int | None = None
    high: int | None = None


@dataclass(frozen=True)
class Manifest:
    """``high`` is the newest time of all batches, expired parts included; ``high_before`` leaves out the last batch."""

    number: int = -1
    parts: tuple[Part, ...] = ()
    last: int = -1
    high: int | None = None
    high_before: int | None = None


def _most(*values: int | None) -> int | None:
    return max((v for v in values if v is not None), default=None)


class Generations:
    """``combine`` merges the rows of several batches into fewer with the same meaning; ``time`` names the column of times.

    With ``horizon``, in microseconds, rows that far behind the newest time are of no more use: they are left out when parts are
    merged, and parts without others are dropped.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        combine: Callable[[DataFrame], DataFrame] | None = None,
        time: str | None = None,
        horizon: int | None = None,
        fan: int = 8,
    ):
        if horizon is not None and time is None or fan < 2:
            raise ValueError("a horizon needs a time column, and parts are merged by two or more")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.combine, self.time, self.horizon, self.fan = combine or (lambda rows: rows), time, horizon, fan
        self._jvm = spark._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def manifest(self) -> Manifest:
        numbers = self._numbers()
        if not numbers:
            return Manifest()
        stream = self._fs().open(self._manifest_path(numbers[-1]))
        try:
            found = json.loads(bytes(self._jvm.io.IOUtils.readFullyToByteArray(stream)).decode())
        finally:
            stream.close()
        return Manifest(**found | {"parts": tuple(Part(**p) for p in found["parts"])})

    def read(self, since: int | None = None) -> DataFrame:
        """The combined rows; with ``since``, only of parts that reach that time."""
        parts = [p for p in self.manifest().parts if since is None or p.high is None or p.high >= since]
        return self.combine(self._rows(parts))

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Add the rows of a batch, unless a part covers it. Batches come in order of their numbers."""
        now = self.manifest()
        if batch <= now.last:
            return False
        part = self._write(rows, Part("", batch, batch))
        now = replace(
            now, number=now.number + 1, parts=(*now.parts, part), last=batch, high=_most(now.high, part.high), high_before=now.high
        )
        self._publish(now)
        self._merge_levels(now)
        return True

    def compact(self) -> None:
        """Merge all parts into one."""
        now = self.manifest()
        if len(now.parts) > 1:
            self._publish(self._merged(now, 0, len(now.parts)))

    def vacuum(self) -> int:
        """Delete the folders and manifests that the newest manifest does not need, and return their number.

        Run it when no older reader and no writer is at work.
        """
        fs, now = self._fs(), self.manifest()
        live = {p.folder for p in now.parts}
        old = [self._path(f"{self.path}/manifests/{self._name(n)}") for n in self._numbers()[:-1]]
        root = self._path(f"{self.path}/parts")
        if fs.exists(root):
            old += [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() not in live]
        for path in old:
            fs.delete(path, True)
        return len(old)

    def _merge_levels(self, now: Manifest) -> None:
        kept = tuple(p for p in now.parts if not self._expired(p, now.high))
        if len(kept) < len(now.parts):
            now = replace(now, number=now.number + 1, parts=kept)
            self._publish(now)
        while True:
            levels = [p.level for p in now.parts]
            full = next((i for i in range(len(levels)) if levels[i : i + self.fan] == [levels[i]] * self.fan), None)
            if full is None:
                return
            now = self._merged(now, full, full + self.fan)
            self._publish(now)

    def _merged(self, now: Manifest, begin: int, end: int) -> Manifest:
        chosen = now.parts[begin:end]
        rows = self._rows(chosen)
        if self.horizon is not None and now.high is not None:
            rows = rows.where(F.unix_micros(self.time) > now.high - self.horizon)
        part = self._write(self.combine(rows), Part("", chosen[0].first, chosen[-1].last, max(p.level for p in chosen) + 1))
        return replace(now, number=now.number + 1, parts=(*now.parts[:begin], part, *now.parts[end:]))

    def _expired(self, part: Part, high: int | None) -> bool:
        return self.horizon is not None and None not in (part.high, high) and part.high <= high - self.horizon

    def _rows(self, parts) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/parts/{p.folder}" for p in parts])

    def _write(self, rows: DataFrame, part: Part) -> Part:
        part = replace(part, folder=f"{part.first}-{part.last}-{uuid.uuid4().hex}")
        rows.write.parquet(f"{self.path}/parts/{part.folder}")
        if self.time is None:
            return part
        time = F.unix_micros(self.time)
        low, high = self._rows([part]).agg(F.min(time), F.max(time)).first()
        return replace(part, low=low, high=high)

    def _publish(self, manifest: Manifest) -> None:
        """Write a manifest beside its place and move it there; a place that is taken means a second writer."""
        fs = self._fs()
        place = self._manifest_path(manifest.number)
        draft = self._path(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(asdict(manifest)).encode()))
        stream.close()
        if fs.exists(place) or not fs.rename(draft, place):
            fs.delete(draft, False)
            raise RuntimeError(f"another writer has published {place}")

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path(f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:012d}.json"

    def _manifest_path(self, number: int):
        return self._path(f"{self.path}/manifests/{self._name(number)}")

    def _path(self, name: str):
        return self._jvm.fs.Path(name)

    def _fs(self):
        return self._path(self.path).getFileSystem(self._conf)
