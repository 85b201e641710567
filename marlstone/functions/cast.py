"""Typed values out of variants: casts that tell missing, null and unusable values apart.

All helpers build Columns; nothing leaves the JVM. A "field" is a variant column: SQL NULL when the key is missing,
a variant null (kind VOID) when the key is there with a null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.config import SETTINGS

_DIGITS = r"\d+(?:_\d+)*"
INT_TEXT = rf"^\s*[+-]?{_DIGITS}\s*$"
#: As INT_TEXT, with a fraction of zeros allowed.
WHOLE_TEXT = rf"^\s*[+-]?{_DIGITS}(?:\.0*)?\s*$"
FLOAT_TEXT = rf"^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))\s*$"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
COMPACT_TEXT = r"^\d{8}T\d{6}$"


def once(c: Column) -> Column:
    """The same value, in a form that the optimiser leaves where it is.

    Filters are otherwise pushed below a projection by repeating what it computes, and projections merged the same
    way: a message that dozens of conditions look into would be parsed dozens of times. The guard is always true.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def apart(c: Column) -> Column:
    """As once(), in a projection that is compiled for itself, in methods of a bounded size.

    Whole-stage code puts neighbouring projections into one method, and HotSpot interprets a method of more than 8,000 bytes for good.
    A projection with a function over an array is left out of whole-stage code. The guard is always true: its array is null, so a row
    costs next to nothing.
    """
    return F.when(F.forall(F.when(F.spark_partition_id() < 0, F.array(F.lit(0))), lambda n: n >= 0).isNull(), c)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of those taken, letter case aside."""
    low = {x.lower() for x in taken}
    name = f"__{name}"
    while name.lower() in low:
        name = f"_{name}"
    return name


def field(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


class Steps:
    """Columns that are made in projections of their own, one step after another: what the next ones name often is computed once.

    The message's fields come first, all in one pass over it.
    """

    def __init__(self, prefix: str, v: Column):
        self.prefix, self.v, self.keys, self.steps = prefix, v, [], [{}, {}, {}]

    def key(self, key: str) -> Column:
        if key not in self.keys:
            if key.lower() in map(str.lower, self.keys):
                return field(self.v, key)  # a struct's fields are told apart without letter case
            self.keys.append(key)
        return F.col(f"{self.prefix}v")[key]

    def let(self, step: int, c: Column) -> Column:
        name = f"{self.prefix}{step}_{len(self.steps[step])}"
        self.steps[step][name] = c
        return F.col(name)

    def applied(self, df: DataFrame, is_object: str) -> DataFrame:
        """df with the steps' columns, and in is_object whether the message is an object."""
        message = f"{self.prefix}v"
        df = df.select("*", apart(F.try_variant_get(self.v, "$", f"struct<{', '.join(f'`{k}` variant' for k in self.keys)}>")).alias(message))
        df = df.withColumn(is_object, F.col(message).isNotNull())
        for step in self.steps:
            if step:
                rest = [c for c in df.columns if c not in (message, is_object)]
                df = df.select(*rest, apart(F.col(is_object)).alias(is_object), *(c.alias(n) for n, c in step.items()))
        return df


class Read:
    """A field that is read in steps: its kind, and whatever of its text, number or variant is asked for, then what is cast
    from these. The functions below take one wherever they take a field.

    A scalar is taken out of a variant at most once, for that costs more than all else that is done with it; whether a value can be cast
    is told by its kind where that suffices, so values that nothing asks for are not taken out at all.
    """

    def __init__(self, steps: Steps, v: Column):
        self.steps, self.field, self.made_columns = steps, v, {}
        self.k = F.schema_of_variant(v)
        self.kind = steps.let(0, self.k)

    def let(self, step: int, name: str, c: Callable[[], Column]) -> Column:
        if name not in self.made_columns:
            self.made_columns[name] = self.steps.let(step, c())
        return self.made_columns[name]

    def get(self, kind: str) -> Column:
        return F.try_variant_get(self.field, "$", kind)

    @property
    def v(self) -> Column:
        return self.let(0, "v", lambda: self.field)

    @property
    def string(self) -> Column:
        return self.let(0, "string", lambda: F.when(self.k == "STRING", self.get("string")))

    @property
    def loose(self) -> Column:
        return self.let(0, "loose", lambda: F.when(is_scalar(self.k), self.get("string")))

    @property
    def number(self) -> Column:
        # a number of its own type is read without a cast
        return self.let(0, "number", lambda: F.when(self.k == "BIGINT", self.get("long").cast("double")).when(is_number(self.k), self.get("double")))

    @property
    def cut(self) -> Column:
        return self.let(0, "cut", lambda: F.when(self.k == "BIGINT", self.get("long")).when(is_number(self.k), self._cut()))

    def _cut(self) -> Column:
        return F.when(F.abs(self.get("double")) < 9.223372036854775807e18, self.get("long"))

    @property
    def whole(self) -> Column:
        n = self.get("double")
        return self.let(0, "whole", lambda: F.when(self.k == "BIGINT", self.get("long")).when(is_number(self.k), F.when((n == F.floor(n)) & (F.abs(n) < 9.2e18), n.cast("long"))))

    @property
    def truth(self) -> Column:
        return self.let(0, "truth", lambda: F.when(self.k == "BOOLEAN", self.get("boolean")))

    @property
    def too_wide(self) -> Column:
        """Whether it is a number that no long can hold."""
        return self.let(0, "wide", lambda: is_number(self.k) & (self.k != "BIGINT") & self._cut().isNull())

    def made(self, cast: Callable[..., Column], step: int = 1) -> Column:
        return self.let(step, cast.__name__, lambda: cast(self))

    def isNull(self) -> Column:  # noqa: N802  as a column's
        return self.kind.isNull()


class _Whole:
    """A field that is read where it is used, by the names of Read."""

    def __init__(self, v: Column):
        self.field, self.kind, n = v, F.schema_of_variant(v), F.try_variant_get(v, "$", "double")
        get, number = lambda kind: F.try_variant_get(v, "$", kind), is_number(self.kind)
        self.string, self.truth, self.number = get("string"), get("boolean"), F.when(number, n)
        self.cut = F.when(self.kind == "BIGINT", get("long")).when(number & (F.abs(n) < 9.223372036854775807e18), get("long"))
        self.whole = F.when(self.kind == "BIGINT", get("long")).when(number & (n == F.floor(n)) & (F.abs(n) < 9.2e18), n.cast("long"))


def _cast(f: Column | Read, cast: Callable[..., Column]) -> Column:
    return f.made(cast) if isinstance(f, Read) else cast(_Whole(f))


def kind(f: Column | Read) -> Column:
    """The variant's type name; NULL if the key is missing, VOID for a null."""
    return f.kind if isinstance(f, Read) else F.schema_of_variant(f)


def is_number(k: Column) -> Column:
    return k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL")


def is_scalar(k: Column) -> Column:
    return (k != "VOID") & ~k.startswith("ARRAY") & ~k.startswith("OBJECT")


def is_null(f: Column | Read) -> Column:
    """Missing or null."""
    return f.isNull() | (kind(f) == "VOID")


def strict_string(f: Column | Read) -> Column:
    """The value of a string, NULL for any other kind."""
    return f.string if isinstance(f, Read) else F.when(kind(f) == "STRING", F.try_variant_get(f, "$", "string"))


def loose_string(f: Column | Read) -> Column:
    """Any scalar as text; NULL for missing, null, arrays and objects."""
    return f.loose if isinstance(f, Read) else F.when(is_scalar(kind(f)), F.try_variant_get(f, "$", "string"))


def _whole(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(t), r"\.0*$", ""), "_", "").try_cast("long")


def _float(t: Column) -> Column:
    return F.regexp_replace(F.trim(t), "_", "").try_cast("double")


def _double(f: Read) -> Column:
    return F.when(is_number(f.kind), f.number).when(f.kind == "BOOLEAN", f.truth.cast("double")).when((f.kind == "STRING") & f.string.rlike(FLOAT_TEXT), _float(f.string))


def _long(f: Read) -> Column:
    return F.when(is_number(f.kind), f.cut).when(f.kind == "BOOLEAN", f.truth.cast("long")).when((f.kind == "STRING") & f.string.rlike(INT_TEXT), _whole(f.string))


def _whole_long(f: Read) -> Column:
    return F.when(is_number(f.kind), f.whole).when(f.kind == "BOOLEAN", f.truth.cast("long")).when((f.kind == "STRING") & f.string.rlike(WHOLE_TEXT), _whole(f.string))


def _cut(f: Read) -> Column:
    return cut_nanoseconds(f.string)


def _moment(f: Read) -> Column:
    return iso_timestamp(moment_text(f))


def to_double(f: Column | Read) -> Column:
    """Numbers, booleans as 1 and 0, and numeric text; NULL otherwise."""
    return _cast(f, _double)


def to_long(f: Column | Read) -> Column:
    """Numbers cut to their whole part, booleans, and text of whole numbers without a fraction; NULL otherwise."""
    return _cast(f, _long)


def is_double(f: Read) -> Column:
    """Whether to_double gives a value; a number isn't read for it."""
    return F.when(is_number(f.kind) | (f.kind == "BOOLEAN"), F.lit(True)).otherwise(F.coalesce((f.kind == "STRING") & f.string.rlike(FLOAT_TEXT) & _float(f.string).isNotNull(), F.lit(False)))


def is_long(f: Read) -> Column:
    """Whether to_long gives a value; a whole number isn't read for it."""
    return F.when(is_number(f.kind) | (f.kind == "BOOLEAN"), ~f.too_wide).otherwise(F.coalesce((f.kind == "STRING") & f.string.rlike(INT_TEXT) & _whole(f.string).isNotNull(), F.lit(False)))


def contract_long(f: Column | Read) -> Column:
    """Whole numbers in any form (12, 12.0, "12", "12.0", true); NULL for 12.5, NaN and anything else."""
    return _cast(f, _whole_long)


def moment_text(f: Read) -> Column:
    """A string's text as cut_nanoseconds leaves it."""
    return f.made(_cut)


def moment(f: Read) -> Column:
    """The instant of a string, cut to microseconds."""
    return f.made(_moment, 2)


contract_double = to_double


def iso_timestamp(t: Column) -> Column:
    """An ISO-8601 text as an instant, cut to microseconds; without a zone it is UTC, whatever the session's zone."""
    dotted, clock = F.when(t.contains(","), F.translate(t, ",", ".")).otherwise(t), F.substr(t, F.lit(12))
    zoned = t.endswith("Z") | ((F.length(t) > 10) & (clock.contains("+") | clock.contains("-")))
    full = F.when(zoned, dotted).when(F.length(t) == 10, F.concat(dotted, F.lit("T00:00:00+00:00"))).otherwise(F.concat(dotted, F.lit("+00:00")))
    return F.when(t.rlike(ISO_TEXT), full.try_cast("timestamp"))


def compact_timestamp(t: Column) -> Column:
    """YYYYMMDDTHHMMSS as an instant in UTC."""
    s = lambda a, n: F.substring(t, a, n)
    iso = F.concat(s(1, 4), F.lit("-"), s(5, 2), F.lit("-"), s(7, 2), F.lit("T"), s(10, 2), F.lit(":"), s(12, 2), F.lit(":"), s(14, 2), F.lit("+00:00"))
    return F.when(t.rlike(COMPACT_TEXT), iso.try_cast("timestamp"))


def published_datetime(t: Column) -> Column:
    """YYYYMMDDTHHMMSS as a date and time without a zone."""
    ts = compact_timestamp(t)
    return F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd HH:mm:ss"))


def cut_nanoseconds(t: Column, compat: bool = False) -> Column:
    """A timestamp's text with six digits of fraction at most.

    compat: over 27 characters become the first 26 and a Z, which loses zone offsets.
    """
    if compat:
        return F.when(F.length(t) > 27, F.concat(F.substring(t, 1, 26), F.lit("Z"))).otherwise(t)
    return F.regexp_replace(t, r"([.,]\d{6})\d+", "$1")


def epoch_seconds(ts: Column) -> Column:
    return ts.cast("timestamp").cast("double")


def format_micros(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS 'UTC'")


def format_seconds(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss 'UTC'")


def lookback_cutoff(now: Column, minutes: int = SETTINGS.lookback_minutes) -> Column:
    """The start of a poll's time range, to the minute, as the news feed takes it."""
    return F.date_format(F.to_utc_timestamp(now, F.current_timezone()) - F.expr(f"INTERVAL {int(minutes)} MINUTES"), "yyyyMMdd'T'HHmm")


def metric_name(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, "[- ]", "_"))


def codes_of(*pairs: tuple[str, Column]) -> Column:
    """The codes whose condition holds, as array<string>; a condition that is NULL doesn't hold.

    Text is joined and split again, for filters over arrays would have all conditions interpreted.
    """
    joined = F.concat_ws(";", *(F.when(c, F.lit(code)) for code, c in pairs))
    return F.when(F.length(joined) == 0, F.array().cast("array<string>")).otherwise(F.split(joined, ";"))
