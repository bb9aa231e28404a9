"""Answers of a model into candidates: strict JSON, one row for each sample."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsumugi import schemas

FIELDS = ("title", "body", "category", "style")
_FENCE = re.compile(r"```(?:json)?")
_SPAN = re.compile(r"\[.*\]", re.DOTALL)


def parse_answer(content: str | None) -> list:
    """The JSON list in an answer. Fences go first; a text that begins with a bracket must be strict JSON as a whole; else the
    span from the first to the last bracket counts, even within an object; else an object is a list of one; else nothing."""
    text = _FENCE.sub("", content or "").strip()
    try:
        if text.startswith("["):
            found = json.loads(text)
        elif span := _SPAN.search(text):
            found = json.loads(span[0])
        elif text.startswith("{"):
            found = [json.loads(text)]
        else:
            return []
    except ValueError:
        return []
    return found if isinstance(found, list) else []


def _sample(item: object) -> dict:
    if not isinstance(item, dict):
        return {"title": None, "body": None, "model_category": None, "model_style": None, "extras": {}, "malformed": True}
    text = {k: item.get(k) if isinstance(item.get(k), str) else None for k in FIELDS}
    extras = {str(k): v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in item.items() if k not in FIELDS}
    return {"title": text["title"], "body": text["body"], "model_category": text["category"], "model_style": text["style"], "extras": extras, "malformed": text["title"] is None or text["body"] is None}


def samples(contents: pd.Series) -> pd.Series:
    return contents.map(lambda c: [_sample(x) for x in parse_answer(c)])


def parsed(content: Column | str) -> Column:
    """Samples of each answer; keys but the four go to ``extras``, items that aren't objects are ``malformed``."""
    return F.pandas_udf(samples, f"array<{schemas.SAMPLE_TYPE}>")(content)


def candidates(answers: DataFrame, per_request: int = 3) -> DataFrame:
    """``answers`` (``category, style, round, batch_idx, content``) as one row a sample, the first ``per_request`` of each."""
    spread = answers.select("category", "style", "round", "batch_idx", F.posexplode(F.slice(parsed("content"), 1, per_request)).alias("sample_idx", "s"))
    return spread.select("category", "style", "round", "batch_idx", "sample_idx", "s.*")
