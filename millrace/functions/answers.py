"""Answers of providers: the JSON object in a text, and its fields by the rules."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

#: Adapters by name, and their tier; 0 is the local pass.
REGISTRY = {"deterministic": 0, "perplexity": 1, "claude": 2, "gemini": 3}
FALLBACK = 0.45
NAMES = ("entity_type_guess", "citations", "extracted_domains", "family_hints", "redirect_hints", "confidence_hint", "notes", "footer_or_company_phrases", "same_backend_or_legal_language_hint")


def adapter(name: str) -> int:
    key = name.strip().lower()
    if key not in REGISTRY:
        raise KeyError(f"unknown provider: {name}")
    return REGISTRY[key]


def object_in(text: str | None) -> str | None:
    """A fenced JSON object, else the first balanced one (braces within strings count), as JSON text; null if it is no JSON."""
    text = (text or "").strip()
    fenced = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", text, re.S | re.I)
    try:
        return json.dumps(json.loads(fenced[1])) if fenced else _balanced(text)
    except ValueError:
        return _balanced(text)


def _balanced(text: str) -> str | None:
    start, depth = text.find("{"), 0
    for m in re.compile("[{}]").finditer(text, max(start, 0)) if start >= 0 else ():
        depth += 1 if m[0] == "{" else -1
        if not depth:
            try:
                return json.dumps(json.loads(text[start : m.end()]))
            except ValueError:
                return None
    return None


def json_object(text: Column) -> Column:
    @F.pandas_udf("string")
    def found(xs: pd.Series) -> pd.Series:
        return xs.map(object_in)

    return found(text)


def _list(x: Column, most: int) -> Column:
    """A list, or one value as a list; blank ones out."""
    xs = F.when(x.startswith("["), F.from_json(x, "array<string>")).when(x.isNotNull(), F.array(x))
    return F.slice(F.coalesce(F.filter(xs, lambda y: y.isNotNull() & (y != "")), F.array().cast("array<string>")), 1, most)


def confidence_of(x: Column) -> Column:
    """A number within 0 and 1; what is none is the fallback."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x.try_cast("double"), F.lit(FALLBACK))))


def fields(parsed: Column) -> Column:
    """struct of an answer's fields: an unknown label is unresolved; single values become lists; lists, notes and confidence are cut to their bounds."""
    p = F.from_json(parsed, ", ".join(f"{n} string" for n in NAMES))
    label = F.trim(F.coalesce(p["entity_type_guess"], F.lit("")))
    return F.struct(
        F.when(label.isin(L.ENTITY_LABELS), label).otherwise("unresolved").alias("entity_type_guess"),
        _list(p["citations"], 30).alias("citations"),
        F.transform(_list(p["extracted_domains"], 30), lambda d: F.trim(F.lower(d))).alias("extracted_domains"),
        _list(p["family_hints"], 20).alias("family_hints"),
        _list(p["redirect_hints"], 20).alias("redirect_hints"),
        confidence_of(p["confidence_hint"]).alias("confidence_hint"),
        F.substring(F.coalesce(p["notes"], F.lit("")), 1, 2000).alias("notes"),
        _list(p["footer_or_company_phrases"], 10).alias("phrases"),
        F.coalesce(p["same_backend_or_legal_language_hint"], F.lit("")).alias("language_hint"),
    )
