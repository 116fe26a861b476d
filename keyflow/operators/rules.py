"""Mapping rules: from key-value events to relational mutations.

A rule is compiled once, on the driver, into column expressions; the first rule that
matches an event decides about it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_TYPE = "struct<rule:int,action:string,table:string,pk:map<string,string>,cols:map<string,string>,error:string>"
#: Commands whose value a string rule may take, and the argument that holds it.
VALUE_ARGUMENT = {"SET": 3, "GETSET": 3, "SETNX": 3, "SETEX": 4, "PSETEX": 4}


class RuleError(ValueError):
    pass


@dataclass
class Rule:
    """``key_pattern``: literals and ``{column}`` captures; ``fields``: hash field to
    column (empty: all, as named); ``json_columns`` likewise a whitelist."""

    table: str
    pk: list[str]
    types: list[str] = field(default_factory=lambda: ["hash", "string"])
    key_pattern: str = ""
    fields: dict[str, str] = field(default_factory=dict)
    value_column: str = "value"
    value_json: bool = False
    json_columns: list[str] = field(default_factory=list)
    delete: str = "row"

    def __post_init__(self):
        if not self.table or not self.pk:
            raise RuleError("a rule needs a table and a primary key")
        if self.delete not in ("row", "ignore"):
            raise RuleError(f"delete must be row or ignore, not {self.delete}")
        self.types = self.types or ["hash", "string"]
        self.pattern = KeyPattern(self.key_pattern) if self.key_pattern else None


class KeyPattern:
    """A capture ends at the first place where the next literal stands, the last one
    takes the rest; there is no backtracking, and a capture may be empty."""

    def __init__(self, text: str):
        parts = re.split(r"\{([^{}]*)\}", text)
        self.literals, self.names = parts[::2], parts[1::2]
        if any("{" in x or "}" in x for x in self.literals):
            raise RuleError(f"unbalanced braces in {text!r}")
        if any(not n for n in self.names):
            raise RuleError(f"empty capture in {text!r}")
        if any(not x for x in self.literals[1:-1]):
            raise RuleError(f"adjacent captures in {text!r}")
        quoted = [r"\Q" + x.replace(r"\E", r"\E\\E\Q") + r"\E" if x else "" for x in self.literals]
        regex = quoted[0]
        for after in quoted[1:]:
            regex += (rf"((?:(?!{after})[\s\S])*)" if after else r"([\s\S]*)") + after
        self.regex = rf"\A{regex}\z"

    def matches(self, key: Column) -> Column:
        if not self.names:
            return key == self.literals[0]
        if len(self.names) > 1:
            return key.rlike(self.regex)
        head, tail = self.literals
        if not tail:
            return key.startswith(head)
        # The capture ends at the first place of the tail, which must be the key's end.
        return key.startswith(head) & (F.locate(tail, key, len(head) + 1) == F.length(key) - len(tail) + 1) & (F.length(key) >= len(head) + len(tail))

    def captures(self, key: Column) -> dict[str, Column]:
        if len(self.names) != 1:
            return {name: F.regexp_extract(key, self.regex, i + 1) for i, name in enumerate(self.names)}
        head, tail = self.literals
        return {self.names[0]: F.substring(key, F.lit(len(head) + 1), F.length(key) - len(head) - len(tail))}


def _pairs(args: Column) -> Column:
    """Field-value pairs of HSET and its like, numbered."""
    count = F.greatest(F.floor((F.size(args) - 2) / 2).cast("int"), F.lit(0))
    steps = F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1))), F.lit(1), count)
    return F.transform(steps, lambda i: F.struct(F.element_at(args, 3 + 2 * i).alias("k"), F.element_at(args, 4 + 2 * i).alias("v"), i.alias("i")))


def _as_map(pairs: Column) -> Column:
    """The last of equal fields wins: pairs sorted by field and place, of which the last
    of each field stays. (The outer arrays bind the sorted pairs, so that they are not
    computed again for each element.)"""
    ordered = F.array_sort(F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), p["i"].alias("i"), p["v"].alias("v"))))
    last = lambda own: F.filter(own, lambda p, at: (at == F.size(own) - 1) | (F.element_at(own, F.least(at + 2, F.size(own)))["k"] != p["k"]))
    return F.map_from_entries(F.transform(F.transform(F.array(ordered), last)[0], lambda p: F.struct(p["k"], p["v"])))


EMPTY = "CAST(map() AS MAP<STRING, STRING>)"


def _renamed(values: Column, fields: dict[str, str]) -> Column:
    if not fields:
        return values
    names = F.create_map(*[F.lit(x) for pair in fields.items() for x in pair])
    renamed = F.transform_keys(F.map_filter(values, lambda k, v: F.map_contains_key(names, k)), lambda k, v: names[k])
    if all(f == c for f, c in fields.items()):
        return F.map_filter(values, lambda k, v: k.isin(*fields))
    return renamed


def _handles(rule: Rule) -> Column:
    """Whether the rule decides about the event."""
    deleting, kind = F.col("op") == "d", F.col("data_type")
    known = kind.isin(*[t for t in rule.types if t in ("hash", "string")])
    return (rule.pattern.matches(F.col("key")) if rule.pattern else F.lit(True)) & (deleting | known)


def _by_rule(rules: list[Rule], make) -> Column:
    """``make(rule)`` of the rule that decides."""
    out = None
    for i, rule in enumerate(rules):
        out = F.when(F.col("__rule") == i, make(rule)) if out is None else out.when(F.col("__rule") == i, make(rule))
    return out


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, computed once: a generator stands between them and what
    uses them, so that no later expression is merged with theirs."""
    both = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.explode(F.array(both)).alias("__settled")).select(*df.columns, "__settled.*")


def map_events(events: DataFrame, rules: list[Rule], compat: bool = False) -> DataFrame:
    """Events with a ``row`` struct each (``ROW_TYPE``): the first deciding rule's; null if
    none decides. Its action is upsert, delete, skip or error.

    Heartbeats are left out. ``args`` must be text (utf8). With ``compat``, removed hash
    fields become empty strings instead of nulls and string values are always the third
    argument. Works in layers, each of which later ones use by name: the deciding rule,
    the event's values, the row's key and columns, the row. So every part is computed
    once, and only for the rule that decides.
    """
    if not rules:
        raise RuleError("no rules")
    args, key, kind, deleting = F.col("args"), F.col("key"), F.col("data_type"), F.col("op") == "d"
    empty, command = F.expr(EMPTY), F.upper("command")
    rule = None
    for i, r in enumerate(rules):
        rule = F.when(_handles(r), i) if rule is None else rule.when(_handles(r), i)
    out = _settled(events.where(F.col("phase") != "heartbeat"), __rule=rule)

    fill = F.lit("" if compat else None).cast("string")
    removed = F.map_from_entries(F.transform(F.array_distinct(F.slice(args, 3, F.greatest(F.size(args) - 2, F.lit(0)))), lambda f: F.struct(f, fill)))
    one = F.create_map(F.try_element_at(args, F.lit(3)), F.try_element_at(args, F.lit(4)))
    pairs = F.when(F.size(args) == 4, one).otherwise(_as_map(_pairs(args)))
    is_hdel = (F.col("command") if compat else command) == "HDEL"
    hash_values = F.when(is_hdel, removed).when(F.lit(compat) | command.isin("HSET", "HMSET"), pairs).otherwise(empty)
    at = F.create_map(*[F.lit(x) for pair in VALUE_ARGUMENT.items() for x in pair])[command]
    value = F.try_element_at(args, F.lit(3)) if compat else F.try_element_at(args, at)
    as_json = [i for i, r in enumerate(rules) if r.value_json]
    parsed = F.transform_values(F.from_json(value, "map<string,string>"), lambda k, v: F.coalesce(v, F.lit("")))
    string_values = F.when(F.col("__rule").isin(*as_json), parsed) if as_json else F.lit(None).cast("map<string,string>")
    live = F.col("__rule").isNotNull() & ~deleting
    values = F.when(live & (kind == "hash"), hash_values).when(live & (kind == "string"), string_values)
    out = _settled(out, __values=values, __value=F.when(live & (kind == "string"), value))

    lookup = F.when(~((kind == "hash") & is_hdel), F.col("__values"))

    def parts_of(r: Rule) -> dict[str, Column]:
        captures = r.pattern.captures(key) if r.pattern else {}
        return {n: captures.get(n, F.try_element_at(lookup, F.lit(n))) for n in r.pk}

    def pk_of(r: Rule) -> Column:
        return F.create_map(*[x for n, c in parts_of(r).items() for x in (F.lit(n), c)])

    def missing_of(r: Rule) -> Column:
        """Key columns without a value; what the key's pattern captures always has one."""
        captured = set(r.pattern.names if r.pattern else ())
        absent = [F.when(c.isNull(), F.lit(n)) for n, c in parts_of(r).items() if n not in captured]
        return F.concat_ws(",", *absent) if absent else F.lit("")

    def cols_of(r: Rule) -> Column:
        if r.value_json:
            text = F.map_filter("__values", lambda k, v: k.isin(*r.json_columns)) if r.json_columns else F.col("__values")
        else:
            text = F.create_map(F.lit(r.value_column), F.col("__value"))
        text = F.when(F.col("__value").isNotNull(), text).otherwise(empty)
        own = F.when(deleting, empty).when(kind == "hash", _renamed(F.col("__values"), r.fields)).when(kind == "string", text).otherwise(empty)
        captured = set(r.pattern.names if r.pattern else ())
        may_meet = not r.fields or r.value_json or any(c in r.pk for c in r.fields.values()) or r.value_column in r.pk or not set(r.pk) <= captured
        return F.map_filter(own, lambda k, v: ~k.isin(*r.pk)) if may_meet else own

    out = _settled(out, __pk=_by_rule(rules, pk_of), __cols=_by_rule(rules, cols_of), __missing=_by_rule(rules, missing_of))
    ignored = [i for i, r in enumerate(rules) if r.delete == "ignore"]
    no_json = F.col("__rule").isin(*as_json) & (kind == "string") & F.col("__value").isNotNull() & F.col("__values").isNull() if as_json else F.lit(False)
    skips = F.when(deleting, F.col("__rule").isin(*ignored) if ignored else F.lit(False)).otherwise(~no_json & (F.coalesce(F.size("__cols"), F.lit(0)) <= 0))
    fails = ~skips & (F.when(deleting, F.lit(False)).otherwise(no_json) | (F.col("__missing") != ""))
    action = F.when(skips, "skip").when(fails, "error").when(deleting, "delete").otherwise("upsert")
    error = F.when(fails, F.when(~deleting & no_json, "the value is no JSON object").otherwise(F.concat(F.lit("no value for key column "), F.col("__missing"))))
    table = _by_rule(rules, lambda r: F.lit(r.table))
    cols = F.when(skips | fails | deleting, empty).otherwise(F.col("__cols"))
    row = F.struct(F.col("__rule").alias("rule"), action.alias("action"), table.alias("table"), F.col("__pk").alias("pk"), cols.alias("cols"), error.alias("error")).cast(ROW_TYPE)
    return _settled(out, row=F.when(F.col("__rule").isNotNull(), row)).drop("__rule", "__values", "__value", "__pk", "__cols", "__missing")


def rows_of(mapped: DataFrame) -> DataFrame:
    """Mutations only: ``table, pk, cols, del`` and the event's position."""
    return mapped.where(F.col("row.action").isin("upsert", "delete")).select(
        "row.table", "row.pk", "row.cols", (F.col("row.action") == "delete").alias("del"),
        F.col("source.filenum").alias("filenum"), F.col("source.offset").alias("offset"), F.col("source.seq").alias("seq"),
    )


def errors_of(mapped: DataFrame) -> DataFrame:
    return mapped.where(F.col("row.action") == "error")


def key_of(pk: Column) -> Column:
    """A row's key to group by: its columns and values in order, each apart, nulls apart
    from any text."""
    return F.array_sort(F.map_entries(pk))


def rendered(values: Column) -> Column:
    """A map as sorted ``k=v`` text for reading (not a key); null values as ``k=\\N``."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(values), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("\\N"))))), ",")


def column_shape(cols: Column, pk: Column, deleted: Column) -> Column:
    """Sorted column names of a mutation; deletions carry the delete sign."""
    names = F.concat(F.map_keys(pk), F.map_keys(cols), F.when(deleted, F.array(F.lit("__DORIS_DELETE_SIGN__"))).otherwise(F.array().cast("array<string>")))
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")
