"""Vectorised Python functions where built-in expressions cannot express the semantics."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.porter import stem


def symbols_to_hex(c: Column) -> Column:
    """Symbols (emoji) as hexadecimal code points; other text unchanged."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if text is None:
                return None
            out, run = [], []
            for ch in text + "\0":
                kind = unicodedata.category(ch)
                if kind in ("So", "Sk"):
                    run.append(f"{ord(ch):x}")
                elif not (run and kind == "Mn"):
                    out.append("-".join(run))
                    run = []
                    out.append(ch)
            return "".join(out)[:-1]

        return texts.map(one)

    return convert(c)


def stemmed(tokens: Column) -> Column:
    """Every token of a ``token_string`` stemmed; each distinct word is stemmed once per worker."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else " " + "  ".join(map(stem, t.split())) + " ")

    return convert(tokens)


def stable_json_hash(text: Column) -> Column:
    """SHA-256 of a JSON document in canonical form: keys sorted, null-free objects, compact. Invalid JSON gives null."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return None if t is None else hashlib.sha256(json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
            except ValueError:
                return None

        return texts.map(one)

    return convert(text)


def book_slug(title: Column) -> Column:
    """Title as ASCII slug: decomposed, lower case, other runs as dashes; ``book`` if nothing is left."""

    @F.pandas_udf("string")
    def convert(titles: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            plain = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
            return re.sub(r"[^a-z0-9]+", "-", plain).strip("-") or "book"

        return titles.map(one)

    return convert(title)


# Names of metadata fields that hold secrets or raw payloads, and values that must not be kept.
_SECRET_KEY = re.compile(r"(^|[_-])(api[-_]?key|key|token|authorization|secret|password|credential)([_-]|$)", re.I)
_PAYLOAD_KEY = re.compile(r"(^|[_-])(raw|payload|body|provider[-_]?request|provider[-_]?response|raw[-_]?request|raw[-_]?response|request[-_]?body|response[-_]?body|request[-_]?payload|response[-_]?payload)([_-]|$)", re.I)
_SECRET_VALUE = re.compile(r"\b(bearer\s+[A-Za-z0-9._~+/=-]+|sk-[A-Za-z0-9_-]+)\b", re.I)
_LOCAL = re.compile(r"[/\\]|[A-Za-z]:")
_DROP = object()


def _safe(value):
    if isinstance(value, str):
        return _DROP if _LOCAL.match(value) or _SECRET_VALUE.search(value) else value
    if isinstance(value, list):
        return [x for x in map(_safe, value) if x is not _DROP]
    if isinstance(value, dict):
        named = {k: re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", k) for k in value}
        kept = {k: _safe(v) for k, v in value.items() if not (_SECRET_KEY.search(named[k]) or _PAYLOAD_KEY.search(named[k]))}
        return {k: v for k, v in kept.items() if v is not _DROP}
    return value


def safe_metadata(text: Column) -> Column:
    """A JSON object without fields named like secrets or raw payloads and without secret or local-path values, at any depth; null
    where nothing is left, for other JSON and for null."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                value = _safe(json.loads(t)) if t is not None else None
            except ValueError:
                return None
            return json.dumps(value, ensure_ascii=False, separators=(",", ":")) if isinstance(value, dict) and value else None

        return texts.map(one)

    return convert(text)
