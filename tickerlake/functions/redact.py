"""Secret redaction: text rules as native Spark expressions, nested values by
their schema, JSON text by a scanner.

The text rules are JVM regex replacements over the whole text, inside
whole-stage codegen. Structs, maps and arrays are walked by their schema, to
any depth, in the JVM as well. Only JSON held in a text column, whose shape
differs from row to row, is scanned in Arrow batches: values keep their exact
spelling, and any depth is reached without recursion.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.schema import REDACTED, SENSITIVE_KEYS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

# ---------------------------------------------------------------------------
# Redaction rules, applied in this order. Java regex syntax;
# ``$1`` is the first group in a replacement. (pattern, replacement)
# White space and letter case are those of Unicode: (?U) for \s, which lacks
# only the separators \x1c-\x1f, and (?iu) for letters.
# ---------------------------------------------------------------------------
SECRET_RULES = (
    ("(?iu)password=['\"]([^'\"]+)['\"]", "password='***REDACTED***'"),
    ("(?iu)&password=[^&]+&", "&password=***REDACTED***&"),
    ("(?iuU)[?&]password=[^&\\s\\x1c-\\x1f]+", "?password=***REDACTED***"),
    ("(?U)(https?://[^\\s\\x1c-\\x1f?]+)\\?[^\\s\\x1c-\\x1f]+", "$1?***REDACTED***"),
    ("(?iuU)token=['\"]?[^'\"&\\s\\x1c-\\x1f]+['\"]?", "token='***REDACTED***'"),
)

# Quoted-key forms found in log tracebacks.
LOG_RULES = (
    ("(?U)'password':[\\s\\x1c-\\x1f]*'[^']*'", "'password': '***REDACTED***'"),
    ("(?U)\"password\":[\\s\\x1c-\\x1f]*\"[^\"]*\"", "\"password\": \"***REDACTED***\""),
    ("password=['\"][^'\"]*['\"]", "password='***REDACTED***'"),
)

# Opt-in: ``token = "..."`` with spaces around ``=``, which the tight rule misses.
LOOSE_TOKEN_RULE = ("(?iuU)(token[\\s\\x1c-\\x1f]*=[\\s\\x1c-\\x1f]*)[\"']?[^\"'&\\s\\x1c-\\x1f]+[\"']?", "$1'***REDACTED***'")


def rules(loose_token: bool = False, log_forms: bool = False) -> tuple[tuple[str, str], ...]:
    out = SECRET_RULES + (LOG_RULES if log_forms else ())
    return out + ((LOOSE_TOKEN_RULE,) if loose_token else ())


def redact_text(col, rule_list: Sequence[tuple[str, str]] | None = None) -> Column:
    """Apply the replacement rules in order to a string column."""
    c = F.col(col) if isinstance(col, str) else col
    for pattern, repl in (rule_list if rule_list is not None else SECRET_RULES):
        c = F.regexp_replace(c, pattern, repl)
    return c


def redact_value(c: Column, kind: T.DataType, keys: Sequence[str] = SENSITIVE_KEYS) -> Column:
    """Structs and maps of any depth with the values of sensitive keys
    (compared without letter case) replaced; every other value as it is.

    A struct's sensitive field becomes the marker. A map has one value type:
    where that is not text, a sensitive value becomes NULL. A list is a value
    like any other and is not looked into.
    """
    lowered = {k.lower() for k in keys}
    if isinstance(kind, T.StructType):
        fields = [(F.lit(REDACTED) if f.name.lower() in lowered else redact_value(c.getField(f.name), f.dataType, keys)).alias(f.name)
                  for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        text = isinstance(kind.valueType, T.StringType)
        marker = F.lit(REDACTED) if text else F.lit(None)
        return F.transform_values(c, lambda k, v: F.when(F.lower(k).isin(list(lowered)), marker).otherwise(
            redact_value(v, kind.valueType, keys)))
    return c


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]', re.S)


def redact_json_text(text: str, keys: frozenset[str]) -> str:
    """The JSON object in ``text`` with the values of sensitive keys replaced,
    in objects within objects to any depth; all else spelled as it was. Text
    that is not a JSON object is kept."""
    if not text.lstrip().startswith("{"):
        return text
    try:
        json.loads(text)
    except ValueError:
        return text
    except RecursionError:       # deeper than the parser goes; the scan below is not bound to that
        pass
    out, copied = [], 0
    stack: list[str] = []        # open brackets
    lists = 0                    # of which lists
    key, skip_from, skip_depth = None, None, 0
    after_key = False            # a colon came: what follows is a value

    def end_value(at: int) -> None:
        nonlocal copied, skip_from
        out.append(text[copied:skip_from] + json.dumps(REDACTED))
        copied, skip_from = at, None

    for m in _TOKEN.finditer(text):
        t = m[0]
        if skip_from is not None:
            if t in "{[":
                skip_depth += 1
            elif t in "}]" and skip_depth:
                skip_depth -= 1
            elif t in "}]," and not skip_depth:
                gap = text[skip_from:m.start()]
                end_value(skip_from + len(gap.rstrip()))
            if skip_from is not None:
                continue
        if t in "{[":
            stack.append(t)
            lists += t == "["
            after_key, key = False, None
        elif t in "}]":
            lists -= stack.pop() == "["
            after_key = False
        elif t == ",":
            after_key, key = False, None
        elif t == ":" and stack and stack[-1] == "{":
            after_key = True
            if key in keys and not lists:
                rest = re.compile(r"\s*").match(text, m.end())
                skip_from, skip_depth = rest.end(), 0
        elif t[0] == '"' and not after_key and stack and stack[-1] == "{":
            key = json.loads(t, strict=False).lower()
    return "".join(out) + text[copied:]


def json_redactor(keys: Sequence[str] = SENSITIVE_KEYS):
    """A column function for JSON text."""
    lowered = frozenset(k.lower() for k in keys)

    @F.pandas_udf("string")
    def redact(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else redact_json_text(v, lowered))

    return redact
