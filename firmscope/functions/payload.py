"""JSON payloads: canonical text and hash, values by a schema, errors as structs, and the text of nested values."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields that texts are read for, and the length of a JSON text.
RULE_FIELDS = ["payout_frequency", "max_drawdown", "daily_drawdown", "rule_changes_frequency"]
PRICING_FIELDS = ["payout_frequency", "payout_split_pct"]
FIELD_TYPES = {"payout_frequency": "string", "max_drawdown": "double", "daily_drawdown": "double", "rule_changes_frequency": "string", "payout_split_pct": "double"}
MOST = 20_000


def _loaded(x: str | None):
    try:
        return json.loads(x)
    except (TypeError, ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _plain(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: "" if (v := _loaded(x)) is None and (x or "").strip() != "null" else json.dumps(v, ensure_ascii=True))


@F.pandas_udf(T.StringType())
def canonical(raw: pd.Series) -> pd.Series:
    """A JSON text with sorted keys at all depths, ASCII only; null for what can't be read. Spark has no writer that sorts keys or escapes so."""
    return raw.map(lambda x: None if (v := _loaded(x)) is None else json.dumps(v, sort_keys=True))


def json_text(raw: Column, most: int = MOST) -> Column:
    """A JSON text as written by the standard library, cut to `most` characters; blank for what can't be read."""
    return F.substring(_plain(raw), 1, most)


def payload_hash(raw: Column) -> Column:
    """SHA-256 of the canonical text: equal for payloads that differ in the order of keys and in blanks only."""
    return F.sha2(canonical(raw), 256)


def by_schema(raw: Column, fields: dict[str, str], shown: int = 500) -> Column:
    """struct(error, raw, each field) of a JSON object: only values of the field's kind are kept.

    Kinds: list (of strings; other items become strings, trimmed; null items are left out), number (numbers, texts that
    are numbers, and booleans as 1 and 0), boolean, string (trimmed). Anything else is null, of a list empty. What can't
    be read, or isn't an object, has the error invalid_json, its first `shown` characters, and no values.
    """
    v = F.try_parse_json(raw)
    good = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    out = [F.when(~good, "invalid_json").alias("error"), F.when(~good, F.substring(F.trim(raw), 1, shown)).alias("raw")]
    for name, kind in fields.items():
        at = F.try_variant_get(v, f"$.{name}", "variant")
        is_ = F.coalesce(F.schema_of_variant(at), F.lit("VOID"))
        text = F.try_variant_get(v, f"$.{name}", "string")
        if kind == "list":
            items = F.try_variant_get(v, f"$.{name}", "array<variant>")
            value = F.when(is_.startswith("ARRAY"), F.transform(F.filter(items, lambda x: ~F.is_variant_null(x)), lambda x: F.trim(x.cast("string")))).otherwise(F.array().cast("array<string>"))
        elif kind == "number":
            number = F.trim(text).try_cast("double")
            value = F.when(is_ == "BOOLEAN", F.try_variant_get(v, f"$.{name}", "boolean").cast("double")).when(is_.rlike("^(ARRAY|OBJECT|VOID)"), None).otherwise(number)
        elif kind == "boolean":
            value = F.when(is_ == "BOOLEAN", F.try_variant_get(v, f"$.{name}", "boolean"))
        elif kind == "string":
            value = F.when(is_ == "STRING", F.trim(text))
        else:
            raise ValueError(f"no such kind: {kind}")
        out.append(F.when(good, value).alias(name))
    return F.struct(*out)


def _texts(v, skipped: tuple[str, ...]) -> list[str]:
    """Texts, numbers and booleans of a value in order; a list of what is left to do takes the place of recursion, so depth is no limit."""
    todo, out = [v], []
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            todo.extend(reversed([y for k, y in x.items() if k not in skipped]))
        elif isinstance(x, list):
            todo.extend(reversed(x))
        elif x is not None and x != "":
            out.append(str(x))
    return out


def nested_text(raw: Column, skipped: tuple[str, ...] = ("_audit", "source_urls")) -> Column:
    """Texts and numbers of a JSON value of any depth in order, joined by blanks, without those under the skipped keys; null for what can't be read."""

    @F.pandas_udf(T.StringType())
    def walk(rows: pd.Series) -> pd.Series:
        return rows.map(lambda x: None if (v := _loaded(x)) is None else " ".join(_texts(v, skipped)).strip())

    return walk(raw)


def audit_json(schema: T.StructType) -> Column:
    """A row of this schema as JSON text in which decimals are texts, so that no digit is lost, and times are ISO texts; nulls stay."""

    def plain(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.DecimalType):
            return c.cast("string")
        if isinstance(kind, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*(plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: plain(x, kind.elementType))
        return c

    return F.to_json(F.struct(*(plain(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields)), {"ignoreNullFields": "false"})
