"""Column preparation (P5–P15): a list of steps, each of which sets one column from built-in expressions.

A step comes as a mapping with ``type``, that type's settings and optionally ``enabled: false``.  Every type is a
small dataclass: its fields are the settings, their defaults and allowed values are declared with the fields, and
``value`` gives the new column's expression.  Steps add no stage of their own: a chain of them is one projection.

=============  =======================================  =====================================================
type           settings                                 result
=============  =======================================  =====================================================
formula        target, expression                       the SQL expression
cast           column, to, on_error (null)              converted; NULL or an error where that fails
replace_value  column, match, with, match_mode (exact)  ``with`` where the value as text matches; letter case
               case_sensitive (false)                   counts only if asked for
fill_null      column, with                             ``with`` for NULL
text_case      column, case                             lower, upper or title case
trim           column, side (both)                      without outer blanks
regex_replace  column, pattern, replacement             all matches replaced
extract        column, pattern, group (0), target       the group of the first match, '' without one
parse_date     column, kind (date), format, on_error    date or timestamp; NULL or an error where that fails
=============  =======================================  =====================================================

Replacement values take the column's type.  Columns are found by exact name; dots and backticks in it are literal.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import MISSING, dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion.functions.columns import col_exact, quote_ident

ON_ERROR = ("null", "error")


def _setting(default=MISSING, one_of: tuple = (), key: str | None = None):
    """A step's setting: required unless it has a default; ``key`` where the mapping's key is a Python keyword."""
    about = {"one_of": one_of, "key": key}
    return field(metadata=about) if default is MISSING else field(default=default, metadata=about)


@dataclass(frozen=True)
class Step:
    """What all steps share: the column they set."""

    @property
    def sets(self) -> str:
        return getattr(self, "target", None) or self.column

    def value(self, schema: StructType) -> Column:
        raise NotImplementedError

    @classmethod
    def read(cls, settings: Mapping) -> Step:
        """The step from its settings; a missing or unknown value names the setting."""
        given = {}
        for f in fields(cls):
            key = f.metadata["key"] or f.name
            value = settings.get(key)
            if value in (None, "") and f.default is MISSING:
                raise ValueError(f"the setting {key!r} is missing")
            if value is None:
                continue
            if f.metadata["one_of"] and value not in f.metadata["one_of"]:
                raise ValueError(f"the setting {key!r} is {value!r}, not one of {', '.join(f.metadata['one_of'])}")
            given[f.name] = value
        return cls(**given)


@dataclass(frozen=True)
class Formula(Step):
    target: str = _setting()
    expression: str = _setting()

    def value(self, schema):
        return F.expr(self.expression)


@dataclass(frozen=True)
class Cast(Step):
    column: str = _setting()
    to: str = _setting()
    on_error: str = _setting("null", ON_ERROR)

    def value(self, schema):
        function = "try_cast" if self.on_error == "null" else "cast"
        return F.expr(f"{function}({quote_ident(self.column)} AS {self.to})")


@dataclass(frozen=True)
class ReplaceValue(Step):
    column: str = _setting()
    match: str = _setting("")
    replacement: object = _setting("", key="with")
    match_mode: str = _setting("exact", ("exact", "contains", "prefix", "suffix", "regex"))
    case_sensitive: bool = _setting(False)

    def value(self, schema):
        text, wanted = col_exact(self.column).cast("string"), str(self.match)
        if self.match_mode == "regex":
            hit = text.rlike(wanted if self.case_sensitive else f"(?i){wanted}")
        else:
            if not self.case_sensitive:
                text, wanted = F.lower(text), wanted.lower()
            compare = {"contains": Column.contains, "prefix": Column.startswith, "suffix": Column.endswith}
            hit = compare.get(self.match_mode, Column.__eq__)(text, wanted)
        kind = schema[self.column].dataType
        return F.when(hit, F.lit(self.replacement).cast(kind)).otherwise(col_exact(self.column))


@dataclass(frozen=True)
class FillNull(Step):
    column: str = _setting()
    replacement: object = _setting("", key="with")

    def value(self, schema):
        return F.coalesce(col_exact(self.column), F.lit(self.replacement).cast(schema[self.column].dataType))


@dataclass(frozen=True)
class TextCase(Step):
    column: str = _setting()
    case: str = _setting(one_of=("lower", "upper", "title"))

    def value(self, schema):
        return F.call_function("initcap" if self.case == "title" else self.case, col_exact(self.column))


@dataclass(frozen=True)
class Trim(Step):
    column: str = _setting()
    side: str = _setting("both", ("both", "left", "right"))

    def value(self, schema):
        return F.call_function({"left": "ltrim", "right": "rtrim"}.get(self.side, "trim"), col_exact(self.column))


@dataclass(frozen=True)
class RegexReplace(Step):
    column: str = _setting()
    pattern: str = _setting("")
    replacement: str = _setting("")

    def value(self, schema):
        return F.regexp_replace(col_exact(self.column), self.pattern, self.replacement)


@dataclass(frozen=True)
class Extract(Step):
    column: str = _setting()
    pattern: str = _setting("")
    group: int = _setting(0)
    target: str = _setting("")

    def value(self, schema):
        if not str(self.group).strip().isdigit():
            raise ValueError(f"the setting 'group' is {self.group!r}, not the number of a group")
        return F.regexp_extract(col_exact(self.column), self.pattern, int(self.group))


@dataclass(frozen=True)
class ParseDate(Step):
    column: str = _setting()
    kind: str = _setting("date", ("date", "timestamp"))
    format: str = _setting("")
    on_error: str = _setting("null", ON_ERROR)

    def value(self, schema):
        function = ("try_to_" if self.on_error == "null" else "to_") + self.kind
        return F.call_function(function, col_exact(self.column), *([F.lit(self.format)] if self.format else []))


# The type names of the configuration.
STEPS = {"formula": Formula, "cast": Cast, "replace_value": ReplaceValue, "fill_null": FillNull,
         "text_case": TextCase, "trim": Trim, "regex_replace": RegexReplace, "extract": Extract,
         "parse_date": ParseDate}


def read_steps(actions) -> list[Step | None]:
    """The steps of a configuration (None for a disabled one); an error names the entry."""
    out = []
    for position, entry in enumerate(actions or ()):
        try:
            if not isinstance(entry, Mapping):
                raise ValueError(f"a step is a mapping, this is a {type(entry).__name__}")
            if entry.get("type") not in STEPS and entry.get("enabled") is not False:
                raise ValueError(f"no step type {entry.get('type')!r}; there are {', '.join(STEPS)}")
            out.append(None if entry.get("enabled") is False else STEPS[entry["type"]].read(entry))
        except ValueError as problem:
            raise ValueError(f"actions[{position}]: {problem}") from problem
    return out


def prepare(df: DataFrame, actions: list | None) -> DataFrame:
    """``df`` after the enabled steps, in order; each sees the columns that those before it have set."""
    for position, step in enumerate(read_steps(actions)):
        if step is None:
            continue
        try:
            if hasattr(step, "column"):
                require_columns(df, [step.column])
            new = step.value(df.schema)
        except ValueError as problem:
            raise ValueError(f"actions[{position}]: {problem}") from problem
        df = df.withColumn(step.sets, new)
    return df


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Raise if ``df`` lacks one of the columns."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
