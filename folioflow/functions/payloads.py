"""Payloads that leave the engine: stable JSON, schema dialects, packed vectors."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(payload) -> bytes:
    """Keys sorted, no blanks, so that equal payloads have equal bytes."""
    return json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()


def canonical_text(body: Column) -> Column:
    """A column of JSON texts in their stable form; null where a text is no JSON. In Arrow batches."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else canonical_json(json.loads(t)).decode()
            except ValueError:
                return None

        return texts.map(one)

    return run(body)


def dialect(schema):
    """A JSON schema for services that know no unions and no additionalProperties: a union with null becomes nullable,
    type names are upper case."""
    if isinstance(schema, list):
        return [dialect(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: dialect(v) for k, v in schema.items() if k != "additionalProperties"}
    kinds = out.get("type")
    if isinstance(kinds, list):
        rest = [k for k in kinds if k != "null"]
        out |= {"type": rest[0] if rest else "null"} | ({"nullable": True} if len(rest) < len(kinds) else {})
    if isinstance(out.get("type"), str):
        out["type"] = out["type"].upper()
    if isinstance(out.get("properties"), dict):  # names of properties are no keywords
        out["properties"] = {k: dialect(v) for k, v in schema["properties"].items()}
    return out


def packed(vector) -> bytes:
    """A vector as little-endian 32-bit floats."""
    return np.asarray(vector, "<f4").tobytes()


def unpacked(data: bytes) -> list[float]:
    return np.frombuffer(data, "<f4").tolist()
