"""Declarative record contracts.

A :class:`Contract` says what a record looks like. Schemas, cleaning expressions, row rules and document
rules are all derived from it as built-in column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "_malformed"

_SPARK_TYPES: Mapping[str, T.DataType] = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}
NUMERIC_KINDS = ("int", "long", "float", "double")


@dataclass(frozen=True)
class Field:
    """One field: its type, its limits and how dirty values are repaired."""

    name: str
    kind: str
    required: bool = False
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple = ()
    pattern: str | None = None
    max_length: int | None = None
    clean: bool = False
    fill: float | None = None
    magnitude: bool = False

    @property
    def numeric(self) -> bool:
        return self.kind in NUMERIC_KINDS

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class Rule:
    """A named test of one column. A null value gives a null outcome, except for ``present``."""

    name: str
    column: str
    test: str
    args: tuple = ()

    def outcome(self, value: Column | None = None) -> Column:
        value = F.col(self.column) if value is None else value
        match self.test:
            case "present":
                return value.isNotNull()
            case "between":
                return value.between(*self.args)
            case "at_least":
                return value >= F.lit(self.args[0])
            case "at_most":
                return value <= F.lit(self.args[0])
            case "one_of":
                return value.isin(*self.args)
            case "matches":
                return value.rlike(self.args[0])
            case "length_at_most":
                return F.char_length(value) <= self.args[0]
        raise ValueError(f"unknown test {self.test!r} in rule {self.name!r}")


@dataclass(frozen=True)
class Policy:
    """How messages are read and how an undecided rule counts.

    ``typed_parse``   parse JSON straight into typed columns (a field of the wrong type becomes null)
                      instead of parsing text and cleaning it afterwards.
    ``three_valued``  leave validity null when no rule fails but one is undecided; such rows belong to
                      neither branch. Otherwise an undecided rule counts as failed.
    """

    typed_parse: bool = False
    three_valued: bool = False


STRICT = Policy()
COMPAT = Policy(typed_parse=True, three_valued=True)


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    closed: bool = False
    version: str | None = None
    valid_from: str | None = None

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"contract {self.name!r} names a field twice")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def struct(self) -> T.StructType:
        """Typed schema; every field is nullable because a record may be broken."""
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    def message_struct(self, policy: Policy, extra: Iterable[T.StructField] = ()) -> T.StructType:
        """Schema a JSON message is parsed with, keeping the text of a record that does not fit it.

        Unless the policy parses straight into the contract's types, numbers are read in double precision
        and moments as text.
        """
        def loose(f: Field) -> T.DataType:
            return T.DoubleType() if f.numeric else T.StringType()

        fields = [T.StructField(f.name, f.spark_type if policy.typed_parse else loose(f)) for f in self.fields]
        return T.StructType([*fields, *extra, T.StructField(MALFORMED, T.StringType())])

    def text_struct(self) -> T.StructType:
        """Schema that reads any value as text."""
        return T.StructType([T.StructField(n, T.StringType()) for n in [*self.names, MALFORMED]])

    def in_force_from(self, moment: str) -> Contract:
        return replace(self, valid_from=moment)

    def row_rules(self) -> list[Rule]:
        """Rules for typed columns. Optional fields may be null, required ones may not."""
        rules: list[Rule] = []
        for f in self.fields:
            if f.required:
                rules.append(Rule(f"{f.name}:required", f.name, "present"))
            if f.minimum is not None:
                rules.append(Rule(f"{f.name}:minimum", f.name, "at_least", (f.minimum,)))
            if f.maximum is not None:
                rules.append(Rule(f"{f.name}:maximum", f.name, "at_most", (f.maximum,)))
            if f.allowed:
                rules.append(Rule(f"{f.name}:enum", f.name, "one_of", f.allowed))
            if f.pattern is not None:
                rules.append(Rule(f"{f.name}:pattern", f.name, "matches", (f.pattern,)))
            if f.max_length is not None:
                rules.append(Rule(f"{f.name}:length", f.name, "length_at_most", (f.max_length,)))
        return rules


# Keywords that say nothing about what is valid.
_NOTES = {"$schema", "$id", "$comment", "title", "description", "examples", "default"}
_OBJECT_KEYWORDS = _NOTES | {"type", "properties", "required", "additionalProperties"}
_FIELD_KEYWORDS = _NOTES | {"type", "format", "minimum", "maximum", "enum", "pattern", "maxLength"}


def _refuse(where: str, spec: Mapping, known: set[str]) -> None:
    if unknown := sorted(set(spec) - known):
        raise ValueError(f"{where}: keywords {', '.join(unknown)} are not known")


def contract_from_json_schema(name: str, document: Mapping) -> Contract:
    """Read ``{"meta": {...}, "schema": {...}}``, the schema being a flat JSON Schema (draft-07) object.

    A keyword that is not understood is refused: leaving it out would let through what it forbids.
    """
    meta, schema = document.get("meta", {}), document["schema"]
    if schema.get("type", "object") != "object" or schema.get("additionalProperties", True) not in (True, False):
        raise ValueError(f"schema {name!r} is not a flat object")
    _refuse(name, schema, _OBJECT_KEYWORDS)
    required = set(schema.get("required", ()))
    fields = []
    for field_name, spec in schema["properties"].items():
        _refuse(f"{name}.{field_name}", spec, _FIELD_KEYWORDS)
        if spec.get("format", "date-time") != "date-time":
            raise ValueError(f"{name}.{field_name}: format {spec['format']!r} is not known")
        kind = {"integer": "int", "number": "double", "string": "string"}[spec["type"]]
        if kind == "string" and spec.get("format") == "date-time":
            kind = "timestamp"
        fields.append(Field(
            field_name,
            kind,
            required=field_name in required,
            minimum=spec.get("minimum"),
            maximum=spec.get("maximum"),
            allowed=tuple(spec.get("enum", ())),
            pattern=spec.get("pattern"),
            max_length=spec.get("maxLength"),
            clean=kind in NUMERIC_KINDS,
        ))
    return Contract(
        name,
        tuple(fields),
        closed=schema.get("additionalProperties") is False,
        version=meta.get("schema_version"),
        valid_from=meta.get("valid_from"),
    )


def all_of(outcomes: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, outcomes)
