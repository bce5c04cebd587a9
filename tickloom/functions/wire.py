"""Column expressions that read one JSON message, keeping the type of every field.

Messages are parsed once into a VARIANT. Unlike ``from_json`` with text fields, this tells the
number 5 from the text "5", which the validation rules need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# What counts as blank around a symbol (Unicode white space and separators 1C-1F).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
    "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f"
    "\u3000"
)

_NUMBER = r"(?:0|[1-9][0-9]{0,11})(?:\.[0-9]{1,12})?"
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# As above, with single underscores between digits.
SPACED_DECIMAL_TEXT = DECIMAL_TEXT.replace("[0-9]+", "[0-9](_?[0-9])*").replace(r"\.?[0-9]*", r"(\.([0-9](_?[0-9])*)?)?")
EPOCH_TEXT = r"^[+-]?[0-9]+(\.[0-9]*)?$"
ISO_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([Tt _][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?([Zz]|[+-][0-9]{2}:?[0-9]{2})?)?$"
MILLISECONDS_FROM = 2e10  # epoch numbers beyond this are milliseconds, below it seconds

FIRST_INSTANT_US = -62135596800000000  # 0001-01-01
LAST_INSTANT_US = 253402300799999999  # 9999-12-31 23:59:59.999999


@dataclass(frozen=True)
class JsonValue:
    """One JSON value: the VARIANT, and the name of its type.

    The type is STRING, BIGINT, DOUBLE, DECIMAL(p,s), BOOLEAN, VOID, ARRAY<..> or OBJECT<..>; both
    are null for an absent field. Each rule below looks at both several times, so they should be
    columns computed once.
    """

    value: Column
    kind: Column

    def cast(self, type_name: str) -> Column:
        return F.try_variant_get(self.value, "$", type_name)

    @property
    def is_number(self) -> Column:
        return self.kind.isin("BIGINT", "DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL")

    @property
    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"

    @property
    def is_empty(self) -> Column:
        """Null, or text, list or object with nothing in it."""
        return F.to_json(self.value).isin("null", '""', "[]", "{}")


@dataclass(frozen=True)
class PlainValue(JsonValue):
    """A JSON value whose text a pattern has cut out of the message; ``value`` is that text."""

    def cast(self, type_name: str) -> Column:
        return self.value if type_name == "string" else self.value.try_cast(type_name)

    @property
    def is_empty(self) -> Column:
        return self.value == ""


@dataclass(frozen=True)
class Shape:
    """The plain spelling of a message: named members in one order, others of simple kinds between them.

    Each member is (name, pattern of its content, kind). Content stands in quotes for STRING; for NUMBER
    it may or may not. Messages of this shape need no parser: their members are groups of the pattern.
    """

    members: tuple[tuple[str, str, str], ...]

    @property
    def pattern(self) -> str:
        names = "|".join(name for name, _, _ in self.members)
        other = rf'"(?!(?:{names})")[A-Za-z_]{{1,20}}": ?(?:"[A-Za-z0-9 ._:+-]{{0,64}}"|[1-9][0-9]{{0,17}}|true|false)'
        parts, group = [], 0
        for name, content, kind in self.members:
            group += 1
            if kind == "NUMBER":
                parts.append(rf'"{name}": ?("?+)({content})\{group}')
                group += 1
            else:
                quote = '"' if kind == "STRING" else ""
                parts.append(f'"{name}": ?{quote}({content}){quote}')
        between = f"(?:, ?{other})*+"
        return rf"^\{{(?:{other}, ?)*+" + f"{between}, ?".join(parts) + between + r"\}$"

    def apart(self, text: Column) -> Column:
        """The groups of the pattern, joined; other texts as they are. ``cut`` looks at it twice: it should be a column computed once."""
        groups = sum(2 if kind == "NUMBER" else 1 for _, _, kind in self.members)
        return F.regexp_replace(text, self.pattern, "\x01".join(f"${g + 1}" for g in range(groups)))

    def cut(self, text: Column, apart: Column) -> Column:
        """The groups of the pattern; null for texts that it doesn't fit."""
        return F.when(apart != text, F.split(apart, "\x01"))

    def fields(self, groups: Column) -> dict[str, JsonValue]:
        """The members, from the column that ``cut`` gave."""
        found, at = {}, 0
        for name, _, kind in self.members:
            shown: Column = F.lit(kind)
            if kind == "NUMBER":
                shown = F.when(groups[at] == "", F.lit("DOUBLE")).otherwise(F.lit("STRING"))
                at += 1
            found[name] = PlainValue(groups[at], shown)
            at += 1
        return found


EXCHANGE_SHAPE = Shape(
    (
        ("s", "[A-Za-z0-9 ]{1,32}", "STRING"),
        ("p", _NUMBER, "NUMBER"),
        ("q", _NUMBER, "NUMBER"),
        ("T", "[1-9][0-9]{0,14}", "BIGINT"),
        ("m", "true|false", "BOOLEAN"),
    )
)
CANONICAL_SHAPE = Shape(
    (
        ("symbol", "[A-Za-z0-9 ]{1,32}", "STRING"),
        ("price", _NUMBER, "NUMBER"),
        ("quantity", _NUMBER, "NUMBER"),
        ("trade_time", "[0-9Tt:., +Zz-]{1,40}", "STRING"),
        ("side", "[a-z]{1,8}", "STRING"),
        ("source", "[A-Za-z0-9_-]{0,32}", "STRING"),
    )
)


def in_brackets(text: Column) -> Column:
    """A message parsed as the only element of an array, as VARIANT; null if that fails.

    The parser stops after the first complete value, so text behind it would go unnoticed. Inside
    brackets such text is an error.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def only_value(bracketed: Column, text: Column) -> Column:
    """The message's value as VARIANT; null unless the text is exactly one JSON value.

    A stray closing bracket could end the array early. Where one follows an object, the message
    must parse inside an object as well.
    """
    single = F.try_variant_get(bracketed, "$[1]", "variant").isNull()
    doubtful = text.rlike(r"\}\s*\]")
    braced = F.try_parse_json(F.concat(F.lit('{"m":'), text, F.lit("}")))
    return F.when(single & (~doubtful | braced.isNotNull()), F.try_variant_get(bracketed, "$[0]", "variant"))


def field(message: Column, name: str) -> Column:
    """A field of the message as VARIANT; null when absent."""
    return F.try_variant_get(message, f"$.{name}", "variant")


def text(json: JsonValue) -> Column:
    """The text of a JSON string; null for any other type."""
    return F.when(json.kind == "STRING", json.cast("string"))


def number(json: JsonValue, underscores: bool = False) -> Column:
    """A DOUBLE from a JSON number, boolean or decimal text; null otherwise. May overflow to infinity."""
    content = json.cast("string")
    plain = F.when(json.is_number | json.is_boolean, json.cast("double")).when(
        (json.kind == "STRING") & content.rlike(DECIMAL_TEXT), content.try_cast("double")
    )
    if not underscores:
        return plain
    return plain.when((json.kind == "STRING") & content.rlike(SPACED_DECIMAL_TEXT), F.replace(content, F.lit("_"), F.lit("")).try_cast("double"))


def normal_symbol(value: Column) -> Column:
    return F.upper(F.btrim(value, F.lit(BLANKS)))


def truthy(json: JsonValue) -> Column:
    """Whether a JSON value counts as true: not absent, null, false, zero or empty."""
    return (
        F.when(json.value.isNull(), F.lit(False))
        .when(json.is_boolean, json.cast("boolean"))
        .when(json.is_number, json.cast("double") != 0)
        .otherwise(~json.is_empty)
    )


def epoch_number(json: JsonValue) -> Column:
    """An epoch given as JSON number, or as a boolean, which counts as 0 or 1."""
    return F.when(json.is_number | json.is_boolean, json.cast("double"))


def epoch_lax(json: JsonValue) -> Column:
    """An epoch given as JSON number or as digits in text."""
    return F.when(json.is_number, json.cast("double")).when(
        (json.kind == "STRING") & json.cast("string").rlike(EPOCH_TEXT), json.cast("string").try_cast("double")
    )


def micros_from_millis(epoch: Column) -> Column:
    return F.rint(epoch * 1e3)


def micros_by_size(epoch: Column) -> Column:
    """Small epoch numbers are seconds, large ones milliseconds."""
    return F.rint(epoch * F.when(F.abs(epoch) > MILLISECONDS_FROM, F.lit(1e3)).otherwise(F.lit(1e6)))


def instant(micros: Column) -> Column:
    """A timestamp from microseconds given as DOUBLE; null outside years 1 to 9999."""
    inside = (micros >= float(FIRST_INSTANT_US)) & (micros <= float(LAST_INSTANT_US))
    return F.timestamp_micros(F.when(inside, micros).cast("bigint"))


def iso_time(json: JsonValue) -> Column:
    """A timestamp from ISO-8601 text; no zone means UTC."""
    content = json.cast("string")
    spelled = F.regexp_replace(F.translate(content, "t_,z", "T .Z"), r"(:.*[+-][0-9]{2})([0-9]{2})$", "$1:$2")
    return F.when(
        (json.kind == "STRING") & content.rlike(ISO_TEXT) & ~content.startswith("0000"), spelled.try_cast("timestamp")
    )
