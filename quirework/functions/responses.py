"""Model responses: reasoning stripped, JSON read tolerantly."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The tags of reasoning.
_TAG = "think|thinking|reasoning|reason"
_READER = json.JSONDecoder(strict=False)  # line ends and tabs inside strings are allowed


def strip_reasoning(c: Column) -> Column:
    """The answer without paired reasoning blocks, without what comes before the last lone closing tag and after the first lone opening tag."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?is)<\s*({_TAG})\s*>.*?<\s*/\s*\1\s*>", "")
    c = F.regexp_replace(c, rf"(?is)^.*<\s*/\s*(?:{_TAG})\s*>", "")
    c = F.regexp_replace(c, rf"(?is)<\s*(?:{_TAG})\s*>.*$", "")
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def stream_text(c: Column) -> Column:
    """The answer of a stream of `data:` lines: the contents of its pieces in order, up to the end mark; pieces of reasoning and lines that are no JSON have no content."""
    lines = F.filter(F.split(F.coalesce(c, F.lit("")), r"\r?\n"), lambda x: F.startswith(x, F.lit("data:")))
    bodies = F.transform(lines, lambda x: F.trim(F.substring(x, F.lit(6), F.length(x))))
    end = F.array_position(bodies, "[DONE]").cast("int")
    return F.array_join(F.transform(F.when(end > 0, F.slice(bodies, 1, end - 1)).otherwise(bodies), lambda x: F.get_json_object(x, "$.choices[0].delta.content")), "")


def content_text(parts: Column) -> Column:
    """The text of an answer that comes as parts (array of type, text): those of reasoning are left out."""
    return F.array_join(F.transform(F.filter(parts, lambda x: ~F.lower(F.coalesce(x["type"], F.lit(""))).isin("reasoning", "thinking", "think")), lambda x: x["text"]), "")


def mend(s: str) -> str:
    """JSON with its usual slips put right in one pass: commas before a closing bracket, backslashes that escape nothing, quotes inside strings."""
    out: list[str] = []
    inside, i = False, 0
    follow = lambda k: s[k:].lstrip()[:1]
    while i < len(s):
        c = s[i]
        if inside and c == "\\":
            two = s[i + 1 : i + 2]
            long = s[i + 2 : i + 6]
            known = two != "" and two in '"\\/bfnrt'
            code = two == "u" and len(long) == 4 and all(x in "0123456789abcdefABCDEF" for x in long)
            out.append(c + two if known or code else "\\\\")
            i += 2 if known or code else 1
            continue
        if c == '"':
            if not inside:
                inside = True
            elif follow(i + 1) in ("", ",", "}", "]", ":"):
                inside = False
            else:
                c = '\\"'
        elif c == "," and not inside and follow(i + 1) in ("]", "}") and follow(i + 1):
            c = ""
        out.append(c)
        i += 1
    return "".join(out)


def _unfence(s: str) -> str:
    lines = s.splitlines()
    if lines and lines[0].strip().startswith("```"):
        lines = lines[1:-1] if lines[-1].strip() == "```" else lines[1:]
    return "\n".join(lines).strip()


def read_objects(text: str) -> list[dict]:
    """The objects of a response: a JSON array's, or a single object. An array goes before an object; prose around either is passed over.

    Raises ValueError, with the beginning of the response, where there is none.
    """
    s = _unfence(text.strip())
    start = next((k for k in (s.find("["), s.find("{")) if k >= 0), 0)
    for candidate, at in ((s, 0), (s, start), (mend(s[start:]), 0)):
        try:
            value, end = _READER.raw_decode(candidate, at)
            if at == 0 and candidate is s and candidate[end:].strip():
                continue
        except ValueError:
            continue
        if isinstance(value, dict):
            return [value]
        if isinstance(value, list):
            return [x for x in value if isinstance(x, dict)]
        break
    raise ValueError(f"no JSON array or object in the response: {s[:200]!r}")


def read_lines(text: str) -> list[dict]:
    """The objects of a response of JSON lines; lines that can't be read are passed over unless none can."""
    s = _unfence(text.strip())
    if s.startswith("["):
        return read_objects(s)
    rows = []
    for line in s.splitlines():
        a, z = line.find("{"), line.rfind("}")
        if 0 <= a < z:
            try:
                value = _READER.decode(line[a : z + 1])
            except ValueError:
                continue
            if isinstance(value, dict):
                rows.append(value)
    return rows or (read_objects(s) if s else [])


@F.pandas_udf(ArrayType(StringType()))
def parse_response(raw: pd.Series) -> pd.Series:
    """Each object of a response as canonical JSON (sorted keys); NULL where nothing can be read."""

    def one(t: str | None) -> list[str] | None:
        try:
            return [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in read_objects(t or "")]
        except ValueError:
            return None

    return raw.map(one)
