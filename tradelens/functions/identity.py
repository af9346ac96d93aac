"""Content-hash row identity: the MD5 of all other columns as text, shown as a UUID."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text a missing value and a boolean take in the hashed row.
NULL_TEXT = "None"
TRUE_TEXT, FALSE_TEXT = "True", "False"


def uuid_text(hex32) -> Column:
    """32 hex digits -> 8-4-4-4-12 UUID text."""
    h = F.col(hex32) if isinstance(hex32, str) else hex32
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _laid_out(sci: Column) -> Column:
    """``d.ddde+xx`` as Python prints the number: fixed from 1e-4 to below 1e16, no idle zeros."""
    def text(p: Column) -> Column:
        d, e, n = p["digits"], p["e"], p["n"]
        exponent = F.format_string("e%s%02d", F.when(e < 0, "-").otherwise("+"), F.abs(e))
        point = F.when(n > 1, ".").otherwise("")
        return (F.when((e < -4) | (e >= 16), F.concat(F.substring(d, 1, 1), point, d.substr(F.lit(2), n), exponent))
                .when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d))
                .when(n <= e + 1, F.concat(F.rpad(d, e + 1, "0"), F.lit(".0")))
                .otherwise(F.concat(d.substr(F.lit(1), e + 1), F.lit("."), d.substr(e + 2, n))))

    def parts(p: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(F.get(p, F.lit(0)), r"\.", ""), "0+$", "")
        return _let(digits, lambda d: F.struct(d.alias("digits"), F.length(d).alias("n"), F.get(p, F.lit(1)).cast("int").alias("e")))

    return _let(_let(F.split(sci, "e"), parts), text)


# Below it doubles are subnormal and may have fewer than 15 telling digits.
_SMALLEST_NORMAL = 2.2250738585072014e-308


def _shortest(x: Column) -> Column:
    """A positive double in the fewest significant digits that read back as it, as ``d.ddde+xx``.

    A normal double that has such a text of at most 15 digits has only one, so those need no
    search; otherwise it takes 16 or 17."""
    def printed(p: Column) -> Column:
        return F.printf(F.concat(F.lit("%."), p.cast("string"), F.lit("e")), x)

    places = F.when(x < _SMALLEST_NORMAL, F.sequence(F.lit(0), F.lit(16))).otherwise(F.array(*map(F.lit, (14, 15, 16))))
    return F.get(F.filter(F.transform(places, printed), lambda s: s.cast("double") == x), F.lit(0))


def _shortest_whole(x: Column) -> Column:
    """The same for whole numbers that fit into a long: they are rounded once, from their exact
    digits, since a text that is rounded twice can end on the wrong side of a half."""
    def rounded(whole: Column, unit: Column) -> Column:
        def text(k: Column) -> Column:
            up = (k["rest"] * 2 > unit) | ((k["rest"] * 2 == unit) & (k["kept"] % 2 == 1))
            cut = F.length(unit.cast("string")) - 1
            return _let((k["kept"] + F.when(up, 1).otherwise(0)).cast("string"), lambda q: F.struct(
                F.concat(q, F.lit("e"), (F.length(q) + cut - 1).cast("string")).alias("text"),
                F.concat(q, F.lit("e"), cut.cast("string")).cast("double").alias("value")))

        return _let(F.struct(F.call_function("div", whole, unit).alias("kept"), (whole % unit).alias("rest")), text)

    def texts(whole: Column) -> Column:
        digits = F.length(whole.cast("string"))
        units = F.transform(F.array(*map(F.lit, (15, 16, 17))), lambda p: F.pow(F.lit(10.0), F.greatest(digits - p, F.lit(0))).cast("long"))
        return F.transform(units, lambda unit: rounded(whole, unit))

    return F.get(F.filter(_let(x.cast("long"), texts), lambda t: t["value"] == x), F.lit(0))["text"]


def _float_text(x: Column) -> Column:
    """The JVM's text is already Python's if it is short and has no exponent: then its at most 15
    digits are the only ones of that length that read back as the number."""
    searched = _let(F.abs(x), lambda v: _laid_out(
        F.when(v.between(2.0**53, 2.0**63 - 1024), _shortest_whole(v)).otherwise(_shortest(v))))
    return _let(x.cast("string"), lambda plain: (
        F.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(F.length(plain).between(1, 16) & ~F.contains(plain, F.lit("E")), plain)
        .when(x.isNotNull(), F.concat(F.when(x < 0, "-").otherwise(""), searched))))


def float_texts(columns: list[Column]) -> Column:
    """An array of the doubles' texts as Python's ``str`` prints them (null stays null).  One
    expression serves all columns, so the plan does not grow with them."""
    return F.transform(F.array(*[c.cast("double") for c in columns]), _float_text)


def _as_text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(c, F.lit(TRUE_TEXT)).when(~c, F.lit(FALSE_TEXT))
    return c.cast("string")


#: Whole doubles below this are told apart, so they can be printed as integers.
EXACT_WHOLE = 2.0**53


def content_id(df: DataFrame, cols: list[str] | None = None, added: tuple[str, ...] = (),
               whole: tuple[str, ...] = ()) -> Column:
    """UUID text of the MD5 of the row's columns joined by ',' (NULL -> 'None').

    ``concat_ws`` alone would skip NULLs, so each value is coalesced first.  Floats are printed as
    Python prints them (``float_texts``), so ids equal those of rows hashed there.
    Two rows with equal content get one id; ``('a,b','c')`` and ``('a','b,c')`` too.

    For tables whose columns have changed: ``added`` columns came later; they are hashed last, as
    ``name=text``, and not at all where they are NULL.  ``whole`` columns were integers at first;
    their whole numbers are hashed as integers.  So a row that could have been loaded before the
    change keeps its id.
    """
    names = [c for c in (cols or df.columns) if c != "id"]
    fields = {f.name: f for f in df.schema.fields}
    floats = [n for n in names if isinstance(fields[n].dataType, (T.FloatType, T.DoubleType))]

    def text(name: str, texts: Column | None) -> Column:
        if name not in floats:
            return _as_text(fields[name])
        out, v = F.get(texts, F.lit(floats.index(name))), F.col(f"`{name}`")
        if name not in whole:
            return out
        return F.when((v == F.rint(v)) & (F.abs(v) < EXACT_WHOLE), v.cast("long").cast("string")).otherwise(out)

    def joined(texts: Column | None) -> Column:
        return F.concat_ws(",", *[F.coalesce(text(n, texts), F.lit(NULL_TEXT)) for n in names if n not in added],
                           *[F.concat(F.lit(f"{n}="), text(n, texts)) for n in added])

    if not floats:
        return uuid_text(F.md5(joined(None)))
    # A single-precision number is printed by its own shortest text.
    values = [F.col(f"`{n}`").cast("string") if isinstance(fields[n].dataType, T.FloatType) else F.col(f"`{n}`") for n in floats]
    return uuid_text(F.md5(_let(float_texts(values), joined)))


def with_row_id(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Put the content-hash ``id`` first (replacing an existing one)."""
    body = df.drop("id") if "id" in df.columns else df
    return body.select(content_id(body, cols).alias("id"), *[F.col(f"`{c}`") for c in body.columns])
