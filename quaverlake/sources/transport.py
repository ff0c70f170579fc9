"""A compact transport of JSON documents: tables of strings and of object shapes, gzip, base64.

A packed value is a reference into the string table (a number), a literal, or a list that
begins with its kind: 0 a list, 1 an object of a shape, 2 a number.
"""

from __future__ import annotations

import base64
import gzip
import json
import math
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds of packed lists, the encoding's name and the largest expanded size.
LIST, OBJECT, NUMBER = 0, 1, 2
ENCODING = "gzip-base64"
LARGEST = 128 << 20


def _strings(value):
    """All strings of a document but the keys of its objects."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, str):
            yield v
        elif isinstance(v, (list, dict)):
            stack.extend(reversed(v if isinstance(v, list) else list(v.values())))


def pack(document, codec: str, shortest: int = 4) -> dict:
    """The envelope of a JSON document; strings of ``shortest`` characters that repeat go to the table."""
    seen = Counter(_strings(document))
    table = {s: n for n, s in enumerate(s for s, k in seen.items() if k > 1 and len(s) >= shortest)}
    shapes: dict[tuple, int] = {}

    def packed(v):
        match v:
            case str():
                return table.get(v, v)
            case None | bool():
                return v
            case int() | float():
                if not math.isfinite(v):
                    raise ValueError("numbers must be finite")
                return [NUMBER, v]
            case list():
                return [LIST, *map(packed, v)]
            case dict():
                return [OBJECT, shapes.setdefault(tuple(v), len(shapes)), *map(packed, v.values())]
        raise ValueError(f"not JSON: {type(v).__name__}")

    body = {"value": packed(document), "strings": list(table), "shapes": [list(s) for s in shapes]}
    raw = json.dumps(body, ensure_ascii=False, separators=(",", ":"), allow_nan=False).encode()
    if len(raw) > LARGEST:
        raise ValueError("the document is too large for the transport")
    text = base64.b64encode(gzip.compress(raw, 6, mtime=0)).decode("ascii")
    return {"codec": codec, "encoding": ENCODING, "uncompressed_bytes": len(raw), "payload": text}


def _expanded(text: str, size: int) -> bytes:
    stream = zlib.decompressobj(31)
    raw = stream.decompress(base64.b64decode(text, validate=True), size + 1)
    if len(raw) != size or not stream.eof or stream.unused_data:
        raise ValueError("the expanded size differs")
    return raw


def unpack(envelope, codec: str):
    """The document of an envelope; anything without a codec is a document already. Damaged ones fail."""
    if not (isinstance(envelope, dict) and "codec" in envelope):
        return envelope
    size = envelope.get("uncompressed_bytes")
    if set(envelope) != {"codec", "encoding", "uncompressed_bytes", "payload"} or (envelope["codec"], envelope["encoding"]) != (codec, ENCODING):
        raise ValueError("another transport")
    if type(size) is not int or not 0 < size <= LARGEST:
        raise ValueError("the size is out of bounds")
    try:
        body = json.loads(_expanded(envelope["payload"], size))
        strings, shapes = body["strings"], body["shapes"]
    except (ValueError, TypeError, KeyError, zlib.error) as e:
        raise ValueError("a damaged transport") from e
    used: tuple[set, set] = set(), set()

    def entry(which: int, table: list, n):
        if type(n) is not int or not 0 <= n < len(table):
            raise ValueError("a reference out of its table")
        used[which].add(n)
        return table[n]

    def plain(v):
        if type(v) is int:
            return entry(0, strings, v)
        if not isinstance(v, list):
            return v
        kind, rest = (v[0], v[1:]) if v else (None, [])
        if kind == LIST:
            return [plain(x) for x in rest]
        if kind == NUMBER and len(rest) == 1:
            return rest[0]
        if kind == OBJECT and rest:
            keys = entry(1, shapes, rest[0])
            if len(keys) == len(rest) - 1:
                return dict(zip(keys, map(plain, rest[1:])))
        raise ValueError("a packed value of no known kind")

    out = plain(body["value"])
    if (len(used[0]), len(used[1])) != (len(strings), len(shapes)):
        raise ValueError("the tables have entries that nothing uses")
    return out


def packed_documents(df: DataFrame, column: str, codec: str) -> DataFrame:
    """Adds ``packed``: the envelope of the JSON text in ``column``, as JSON."""

    @F.pandas_udf("string")
    def one(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json.dumps(pack(json.loads(t), codec)), na_action="ignore")

    return df.withColumn("packed", one(column))


def unpacked_documents(df: DataFrame, column: str, codec: str) -> DataFrame:
    """Adds ``document``: the JSON text of the envelope in ``column``, null for a damaged one, whose ``fault`` says why."""

    @F.pandas_udf("document string, fault string")
    def one(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append((None if t is None else json.dumps(unpack(json.loads(t), codec), ensure_ascii=False, separators=(",", ":")), None))
            except ValueError as e:
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["document", "fault"])

    return df.withColumn("_u", one(column)).select(*df.columns, "_u.document", "_u.fault")
