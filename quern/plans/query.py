"""The query language: SELECT style and tag style, compiled to a DataFrame plan.

Differences from a general SQL are part of the language: conditions are all ANDed; a comparison with a missing value is
false; strings compare without regard to case; groups are counted, not aggregated. With compat=True the historical quirks
hold: OR and NOT are read and ignored, COUNT(*) is the size of the unfiltered input, aggregates run over grouped input
unfiltered. Without it OR and NOT are refused and aggregates are over the filtered rows. Groups are sorted by key, and
ORDER BY is made total by a tie-break column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names under which fields may be written in conditions.
ALIASES = {"cat": "category", "subcat": "subcategory", "q": "quality_score", "quality": "quality_score", "lic": "license", "ver": "verification_status", "status": "verification_status", "type": "knowledge_type", "lang": "language", "diff": "difficulty", "source": "source_id"}
FUNCTIONS = ("COUNT", "SUM", "AVG", "MIN", "MAX")
_WORDS = {"SELECT", "WHERE", "AND", "OR", "NOT", "GROUP", "ORDER", "BY", "ASC", "DESC", "LIMIT", "OFFSET", "IN", "EXISTS", "AS", "FROM"}
_TOKEN = re.compile(r"""\s*(?:(?P<string>"[^"]*"|'[^']*')|(?P<number>-?\d+(?:\.\d+)?(?![\w]))|(?P<op>!=|<=|>=|=|<|>)|(?P<mark>[(),*])|(?P<name>[A-Za-z0-9_][\w.\-]*))""")


class QueryError(ValueError):
    """The query cannot be read, or does not fit the data."""


@dataclass
class Condition:
    field: str
    op: str
    value: object = None


@dataclass
class Query:
    fields: list[str] = field(default_factory=list)
    aggregates: list[tuple[str, str]] = field(default_factory=list)
    conditions: list[Condition] = field(default_factory=list)
    group_by: str | None = None
    order_by: str | None = None
    descending: bool = False
    limit: int | None = None
    offset: int = 0


@dataclass
class Result:
    """Lazy frames: the rows, the group counts and the one-row aggregates, as far as the query asks for them."""

    records: DataFrame
    groups: DataFrame | None = None
    aggregations: DataFrame | None = None


def literal(text: str) -> object:
    """true/yes, false/no, integers and decimals by their look; everything else is a string."""
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1]
    low = text.lower()
    if low in ("true", "yes", "false", "no"):
        return low in ("true", "yes")
    for kind in (int, float):
        if re.fullmatch(r"-?\d+(\.\d+)?", text):
            try:
                return kind(text)
            except ValueError:
                continue
    return text


class _Reader:
    def __init__(self, text: str):
        self.items: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m or m.end() == at:
                raise QueryError(f"unexpected character {text[at]!r} at {at}")
            kind = m.lastgroup
            value = m[kind]
            self.items.append(("word", value.upper()) if kind == "name" and value.upper() in _WORDS else (kind, value))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.items[self.at] if self.at < len(self.items) else ("end", "")

    def take(self, *wanted: str) -> bool:
        if self.peek()[0] in ("word", "mark") and self.peek()[1] in wanted:
            self.at += 1
            return True
        return False

    def need(self, *kinds: str) -> str:
        kind, value = self.peek()
        if kind not in kinds:
            raise QueryError(f"expected {' or '.join(kinds)}, found {value or 'the end'}")
        self.at += 1
        return value


def _value(r: _Reader) -> object:
    kind = r.peek()[0]
    text = r.need("string", "number", "name")
    return text[1:-1] if kind == "string" else literal(text)


def _conditions(r: _Reader, compat: bool) -> list[Condition]:
    out = []
    while r.peek()[0] != "end" and r.peek()[1] not in ("GROUP", "ORDER", "LIMIT", "OFFSET"):
        if r.take("AND"):
            continue
        if r.take("OR", "NOT", "(", ")"):
            if not compat:
                raise QueryError("OR, NOT and brackets have no meaning in this language")
            continue
        if r.take("EXISTS"):
            bracket = r.take("(")
            out.append(Condition(r.need("name"), "exists"))
            if bracket and not r.take(")"):
                raise QueryError("expected )")
            continue
        name = r.need("name")
        if r.take("IN"):
            if not r.take("("):
                raise QueryError("expected ( after IN")
            values = []
            while not r.take(")"):
                values.append(_value(r))
                r.take(",")
            out.append(Condition(name, "in", values))
        elif r.peek()[0] == "op":
            out.append(Condition(name, r.need("op"), _value(r)))
        else:
            r.take("EXISTS")
            out.append(Condition(name, "exists"))
    return out


def _select(text: str, compat: bool) -> Query:
    r, q = _Reader(text), Query()
    r.take("SELECT")
    while r.peek()[0] in ("name", "mark") or r.peek() == ("word", "AS"):
        if r.take("*", ","):
            continue
        if r.take("AS"):
            r.need("name")
            continue
        name = r.need("name")
        if name.upper() in FUNCTIONS and r.take("("):
            what = "*" if r.take("*") else r.need("name")
            if not r.take(")"):
                raise QueryError("expected )")
            q.aggregates.append((name.upper(), what))
        else:
            q.fields.append(name)
    if r.take("FROM"):
        r.need("name")
    if r.take("WHERE"):
        q.conditions = _conditions(r, compat)
    while r.peek()[0] != "end":
        if r.take("GROUP"):
            r.take("BY")
            q.group_by = r.need("name")
        elif r.take("ORDER"):
            r.take("BY")
            q.order_by = r.need("name")
            q.descending = r.take("DESC")
            r.take("ASC")
        elif r.take("LIMIT"):
            q.limit = int(r.need("number"))
        elif r.take("OFFSET"):
            q.offset = int(r.need("number"))
        else:
            raise QueryError(f"unexpected {r.peek()[1]}")
    return q


def _tags(text: str) -> Query:
    q = Query()
    parts = re.findall(r"""[\w.\-]+\s+in\s*\([^)]*\)|[\w.\-]+(?::|!=|<=|>=|=|<|>)(?:"[^"]*"|\S+)|\S+""", text, re.I)
    for part in parts:
        if m := re.fullmatch(r"([\w.\-]+)\s+in\s*\(([^)]*)\)", part, re.I):
            q.conditions.append(Condition(m[1], "in", [literal(x.strip()) for x in m[2].split(",") if x.strip()]))
        elif m := re.fullmatch(r"([\w.\-]+)(:|!=|<=|>=|=|<|>)(.*)", part):
            q.conditions.append(Condition(m[1], "=" if m[2] == ":" else m[2], literal(m[3])))
        elif re.fullmatch(r"[\w.\-]+", part):
            if part.upper() not in ("AND", "OR", "NOT"):
                q.conditions.append(Condition(part, "exists"))
        else:
            raise QueryError(f"cannot read {part!r}")
    return q


def parse(text: str, compat: bool = False) -> Query:
    q = _select(text, compat) if text.strip().upper().startswith("SELECT") else _tags(text)
    for c in q.conditions:
        c.field = ALIASES.get(c.field.lower(), c.field)
    return q


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _truthy(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.NumericType):
        test = c != 0
    elif isinstance(kind, T.StringType):
        test = c != ""
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def condition(c: Condition, types: dict[str, T.DataType]) -> Column:
    """One condition as a Boolean column that is never null."""
    if c.field not in types:
        return F.lit(False) if c.op != "in" else F.lit("" in [str(v).lower() for v in c.value])
    kind, col = types[c.field], F.col(f"`{c.field}`")
    if c.op == "exists":
        return _truthy(c.field, kind)
    if c.op == "in":
        return F.lower(F.coalesce(col.cast("string"), F.lit(""))).isin([str(v).lower() for v in c.value])
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(c.op == "!=") & col.isNotNull()
    value = c.value
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(kind, T.StringType):
        left, right = (F.expr(f"try_cast(`{c.field}` AS DOUBLE)"), F.lit(float(value))) if number else (F.lower(col), F.lit(str(value).lower()))
    elif isinstance(kind, T.BooleanType):
        left, right = (col, F.lit(value)) if isinstance(value, bool) else (col.cast("int"), F.lit(value)) if number else (F.lower(col.cast("string")), F.lit(str(value).lower()))
    elif isinstance(kind, T.NumericType):
        if isinstance(value, str):
            if c.op not in ("=", "!="):
                raise QueryError(f"{c.field} is a number and cannot be ordered against {value!r}")
            return F.lit(c.op == "!=") & col.isNotNull()
        left, right = col, F.lit(int(value) if isinstance(value, bool) else value)
    else:
        left, right = col, F.lit(value)
    test = {"=": left == right, "!=": left != right, "<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[c.op]
    return F.coalesce(test, F.lit(False))


def _aggregate(df: DataFrame, wanted: list[tuple[str, str]], total: DataFrame | None) -> DataFrame:
    """One row; only numbers count, Booleans as 0 and 1, an average is rounded half to even, nothing gives 0."""
    types = _types(df)
    out = []
    for name, what in wanted:
        alias = f"{name.lower()}_{'all' if what == '*' else what}"
        kind = types.get(what)
        if name == "COUNT":
            out.append((F.count("*") if what == "*" or kind is None else F.count(f"`{what}`")).alias(alias))
            continue
        if not isinstance(kind, (T.NumericType, T.BooleanType)):
            out.append(F.lit(0).alias(alias))
            continue
        c = F.col(f"`{what}`").cast("int") if isinstance(kind, T.BooleanType) else F.col(f"`{what}`")
        value = {"SUM": F.sum(c), "AVG": F.bround(F.avg(c), 2), "MIN": F.min(c), "MAX": F.max(c)}[name]
        out.append(F.coalesce(value, F.lit(0)).alias(alias))
    one = df.agg(*out)
    if total is not None and ("COUNT", "*") in wanted:
        one = one.drop("count_all").crossJoin(total.agg(F.count("*").alias("count_all")))  # two single rows
    return one


def execute(query: str | Query, df: DataFrame, tie_break: str | None = None, compat: bool = False) -> Result:
    """Filter, group counts, order, offset and limit, project, aggregate: in this order."""
    q = parse(query, compat) if isinstance(query, str) else query
    types = _types(df)
    rows = df.where(reduce(lambda a, b: a & b, [condition(c, types) for c in q.conditions])) if q.conditions else df
    groups = None
    if q.group_by:
        key = F.coalesce(F.col(f"`{q.group_by}`").cast("string"), F.lit("unknown")) if q.group_by in types else F.lit("unknown")
        groups = rows.groupBy(key.alias("key")).agg(F.count("*").alias("n")).orderBy("key")
    filtered = rows
    if q.order_by:
        if q.order_by not in types:
            raise QueryError(f"no field {q.order_by} to order by")
        c = F.col(f"`{q.order_by}`")
        rows = rows.orderBy(c.desc_nulls_last() if q.descending else c.asc_nulls_first(), *([F.col(tie_break)] if tie_break else []))
    if q.offset:
        rows = rows.offset(q.offset)
    if q.limit is not None:
        rows = rows.limit(q.limit)
    cut = rows
    if q.fields:
        rows = rows.select(*(F.col(f"`{f}`") if f in types else F.lit(None).cast("string").alias(f) for f in q.fields))
    aggregations = None
    if q.aggregates:
        over = (df if q.group_by else rows) if compat else (filtered if q.group_by else cut)
        aggregations = _aggregate(over, q.aggregates, df if compat else None)
    return Result(rows, groups, aggregations)


def preview(query: str, df: DataFrame, n: int = 10) -> tuple[DataFrame, int]:
    """The first n rows, and how many there are."""
    rows = execute(query, df).records
    return rows.limit(n), rows.count()


def validate(query: str, fields: set[str] | None = None) -> list[str]:
    """Errors of a query; with `fields`, names that are not among them are errors too."""
    try:
        q = parse(query)
    except QueryError as e:
        return [str(e)]
    named = [c.field for c in q.conditions] + q.fields + [f for f in (q.group_by, q.order_by) if f]
    return [f"unknown field {f}" for f in dict.fromkeys(named) if fields is not None and f not in fields]


def describe(query: str) -> str:
    q = parse(query)
    says = {"=": "is", "!=": "is not", "in": "is one of", "exists": "exists"}
    parts = [f"{c.field} {says.get(c.op, c.op)}" + ("" if c.op == "exists" else f" {c.value}") for c in q.conditions]
    text = "Rows" + (f" where {' and '.join(parts)}" if parts else "")
    text += f", counted by {q.group_by}" if q.group_by else ""
    text += f", ordered by {q.order_by} {'descending' if q.descending else 'ascending'}" if q.order_by else ""
    text += f", after the first {q.offset}" if q.offset else ""
    return text + (f", at most {q.limit}" if q.limit is not None else "")
