"""A data source of tar archives: members are streamed, never unpacked to disk.

``spark.read.format("tar_members").option("path", ...).load()`` gives (member, size,
sha256, body). Each archive is one partition, as gzip can't be split. Unsafe names
and two members of one name with different bodies fail; equal ones come once. So do
archives with more members or bytes than the options allow, and JSON members that
repeat a key or whose id isn't the one that their name says.
"""

from __future__ import annotations

import hashlib
import json
import tarfile

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_MEMBER = 64 << 20


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _once(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key that repeats")
    return out


def checked_json(name: str, body: bytes, id_key: str | None) -> None:
    """Fails unless the body is JSON without repeated keys and, with ``id_key``, has the id that its file name is."""
    try:
        value = json.loads(body, object_pairs_hook=_once)
    except ValueError as e:
        raise ValueError(f"member {name}: {e}") from e
    stem = name.rsplit("/", 1)[-1].split(".", 1)[0]
    if id_key and (not isinstance(value, dict) or str(value.get(id_key)) != stem):
        raise ValueError(f"member {name}: its {id_key} is another one")


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], options: dict):
        self.paths, self.suffix = paths, options.get("suffix", "")
        self.members, self.bytes = int(options.get("maxmembers", 10**6)), int(options.get("maxbytes", 1 << 38))
        self.json, self.id_key = str(options.get("json", "false")).lower() == "true", options.get("idkey")
        names = options.get("names")
        self.names = set(names.split(",")) if names else None

    def partitions(self):
        return [_Archive(p) for p in self.paths]

    def read(self, partition):
        seen: dict[str, str] = {}
        held = 0
        with tarfile.open(partition.path, "r|*") as tar:
            for m in tar:
                name = m.name.removeprefix("./")
                if not m.isfile() or not name.endswith(self.suffix):
                    continue
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"unsafe member {name}")
                if self.names is not None and name not in self.names:
                    continue
                held += m.size
                if len(seen) >= self.members or held > self.bytes:
                    raise ValueError(f"{partition.path} holds more than is allowed")
                if m.size > MAX_MEMBER:
                    raise ValueError(f"member {name} has {m.size} bytes")
                body = tar.extractfile(m).read()
                digest = hashlib.sha256(body).hexdigest()
                if name in seen:
                    if seen[name] != digest:
                        raise ValueError(f"two different members {name}")
                    continue
                seen[name] = digest
                if self.json:
                    checked_json(name, body, self.id_key)
                yield name, len(body), digest, body


class TarMembers(DataSource):
    """Options: path (comma-separated for several), suffix and names of the members that are read, maxMembers, maxBytes, json, idKey."""

    @classmethod
    def name(cls):
        return "tar_members"

    def schema(self):
        return "member string, size long, sha256 string, body binary"

    def reader(self, schema):
        return _Reader(self.options["path"].split(","), {k.lower(): v for k, v in self.options.items()})
