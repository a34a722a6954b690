"""JSON out of model answers. The built-in parser goes first; only what it cannot read reaches the Arrow functions."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_COMMA = re.compile(r",\s*([}\]])")


def _loads(text: str):
    for t in (text, _COMMA.sub(r"\1", text)):
        try:
            return json.loads(t)
        except ValueError:
            pass
    return None


def first_object(text: str) -> str | None:
    """The first balanced {...} that parses. Braces are counted whether or not they stand in strings."""
    at = text.find("{")
    while at >= 0:
        depth = 0
        for i in range(at, len(text)):
            depth += (text[i] == "{") - (text[i] == "}")
            if depth == 0:
                got = _loads(text[at : i + 1])
                if isinstance(got, dict):
                    return json.dumps(got, ensure_ascii=False)
                break
        at = text.find("{", at + 1)
    return None


def complete_members(text: str) -> str | None:
    """The whole members of a top-level object that was cut off; strings are respected. Null if none is whole."""
    at = text.find("{")
    if at < 0:
        return None
    decoder, out, i = json.JSONDecoder(), {}, at + 1
    try:
        while True:
            while i < len(text) and text[i] in " \t\r\n,":
                i += 1
            name, i = decoder.raw_decode(text, i)
            while text[i] in " \t\r\n:":
                i += 1
            value, i = decoder.raw_decode(text, i)
            if not isinstance(name, str):
                break
            out[name] = value
    except (ValueError, IndexError):
        pass
    return json.dumps(out, ensure_ascii=False) if out else None


@F.pandas_udf(StringType())
def _scan(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else first_object(x))


@F.pandas_udf(StringType())
def _recover(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else complete_members(x))


def _parsed(text: Column) -> Column:
    return F.when(F.try_parse_json(text).isNotNull() & F.trim(text).startswith("{"), text)


def extract_object(text: Column) -> Column:
    """JSON text of the object in a model's answer: plain, fenced, with trailing commas, or found by braces."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    fixed = lambda t: F.regexp_replace(t, r",\s*([}\]])", "$1")
    easy = F.coalesce(_parsed(text), _parsed(fenced), _parsed(fixed(fenced)))
    return F.coalesce(easy, _scan(F.when(easy.isNull(), text)))


def recover_object(text: Column) -> Column:
    easy = _parsed(text)
    return F.coalesce(easy, _recover(F.when(easy.isNull(), text)))
