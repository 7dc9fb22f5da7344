"""Nested documents to flat rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.schemas import c, q


def _leaves(schema: T.StructType, parent: Column | None, prefix: str, sep: str) -> list[tuple[str, Column]]:
    out: list[tuple[str, Column]] = []
    for field in schema.fields:
        col = c(field.name) if parent is None else parent.getField(field.name)
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, col, name + sep, sep)
        else:
            out.append((name, col))
    return out


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested field as a top-level column named by its path (``a.b.c``).

    Driven by the schema alone, so no job runs; array columns stay as they are.
    """
    return df.select(*[col.alias(name) for name, col in _leaves(df.schema, None, "", sep)])


def explode_path(
    df: DataFrame,
    path: Sequence[str],
    keep: Sequence[str] = (),
    parents: Mapping[str, str] | None = None,
    positions: bool = False,
    flatten: bool = True,
) -> DataFrame:
    """One row per element of the last array on ``path``.

    ``path`` names an array in ``df`` (``"liveData.plays.allPlays"``), then an
    array in its elements, and so on. ``keep`` carries columns of ``df`` along;
    ``parents`` carries fields of the elements passed on the way, as
    ``{output name: "step.field"}`` with the step counted from 0. With
    ``positions`` each step's element number comes out as ``pos_0``, ``pos_1`` …
    Elements whose next array is empty or missing give no rows.
    """
    parents = dict(parents or {})
    wanted: dict[int, list[tuple[str, str]]] = {}
    for out, source in parents.items():
        step, field = source.split(".", 1)
        wanted.setdefault(int(step), []).append((out, field))

    carried = [q(k) for k in keep]
    current = df
    for step, name in enumerate(path):
        array = F.col(name) if step == 0 else F.col("_el").getField(name)
        current = current.select(*carried, F.posexplode(array).alias(f"pos_{step}", "_el"))
        if positions:
            carried.append(f"pos_{step}")
        for out, field in wanted.get(step, []):
            current = current.withColumn(out, F.col(f"_el.{field}"))
            carried.append(q(out))
    if not flatten:
        return current.select(*carried, F.col("_el").alias("element"))
    element = current.schema["_el"].dataType
    leaves = [("element", F.col("_el"))]
    if isinstance(element, T.StructType):
        leaves = _leaves(element, F.col("_el"), "", ".")
    return current.select(*carried, *[col.alias(name) for name, col in leaves])


def _is_list(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType))


def drop_list_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold arrays or maps; found in the schema, no job runs."""
    return df.select(*[c(f.name) for f in df.schema.fields if not _is_list(f.dataType)])


def class_table(df: DataFrame) -> DataFrame:
    """``(variable, value)``: each column's name and class, array and map columns as ``list``."""
    classes = [
        F.lit("list" if _is_list(f.dataType) else f.dataType.simpleString()).alias(f.name) for f in df.schema.fields
    ]
    one_row = df.sparkSession.range(1).select(*classes)
    return one_row.unpivot([], [c(n) for n in one_row.columns], "variable", "value")


def _meta_paths() -> dict[str, str]:
    out: dict[str, str] = {}
    for side in ("home", "away"):
        team = f"gameData.teams.{side}"
        out[f"{side}_team"] = f"{team}.name"
        for part, name in (("sport", "level"), ("league", "league")):
            out[f"{side}_{name}_id"] = f"{team}.{part}.id"
            out[f"{side}_{name}_name"] = f"{team}.{part}.name"
    return out | {"game_status": "gameData.status.abstractGameState", "date_time": "gameData.datetime.dateTime"}


# Where the scalars of a game document stand, by output name.
META_PATHS: dict[str, str] = _meta_paths()


def game_meta(current: bool = False) -> dict[str, Column]:
    """The scalars of a game document as columns, on request with the current play."""
    paths = META_PATHS | ({"current_play": "liveData.plays.currentPlay"} if current else {})
    return {name: F.col(path) for name, path in paths.items()}


def found_schema(df: DataFrame, text: str) -> str:
    """The schema of all JSON documents of a column together, found in one pass over them, as ``from_json`` takes it.

    Fields of every document are in it, by name. Numbers of different kinds
    widen; a field that is a scalar in one document and a list or struct in
    another comes as VARIANT, one that is always null as a text. Texts that are
    no JSON don't count. Only the schema reaches the driver.
    """
    found = df.select(F.try_parse_json(c(text)).alias("_v")).agg(F.schema_of_variant_agg("_v")).first()[0]
    found = None if found == "VOID" else found
    if found is None or not found.startswith("OBJECT<"):
        raise ValueError("the documents are not all JSON objects" if found else "there are no documents to find a schema in")
    # Names in backticks stay as they are.
    words = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    return re.sub(r"`(?:[^`]|``)*`|OBJECT<|\bVOID\b(?!:)", lambda m: words.get(m[0], m[0]), found)


def flatten_documents(df: DataFrame, text: str, keep: Sequence[str] = (), schema: str | None = None, sep: str = ".") -> DataFrame:
    """JSON documents as one flat column per scalar path, whatever fields they have; ``keep`` stands before them.

    Without a ``schema`` it is found in the documents first, which reads them
    once. ``status`` is ``error`` for a text that is no JSON; its fields are
    NULL. Lists stay lists (see :func:`explode_path`).
    """
    schema = schema or found_schema(df, text)
    good = F.try_parse_json(c(text)).isNotNull()
    status = F.when(good, "ok").otherwise("error").alias("status")
    parsed = df.select(*[c(k) for k in keep], status, F.from_json(F.when(good, c(text)), schema).alias("_d"))
    clash = {*keep, "status"} & {f.name for f in parsed.schema["_d"].dataType.fields}
    if clash:
        raise ValueError(f"documents have {sorted(clash)} too")
    leaves = _leaves(parsed.schema["_d"].dataType, F.col("_d"), "", sep)
    return parsed.select(*[c(k) for k in keep], "status", *[col.alias(name) for name, col in leaves])
