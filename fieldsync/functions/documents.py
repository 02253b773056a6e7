"""JSON held as text: validity, property lists, members and payloads.

Documents are read with declared structs of strings. Of a repeated member the
last counts, numbers and objects come out as their text, and an absent member
is NULL. A struct read never fails, so validity is a separate test.

The reader would make `1.50` a `1.5`. Numbers with a fraction are therefore put in quotes with a mark before
a document is read (`as_written`), and taken out of them in what was read (`written`). Numbers with an exponent
stay as the reader gives them, and so does a document that holds the mark itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Only what the JSON standard allows.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# What a JSON value can start with.
_START = r"^[ \t\r\n]*[\[{\"0-9tfn-]"

_END = "\u241e end"
_MARK = "\u241d"

# What comes before a number with a fraction: strings, numbers that are none, anything else but a digit or a sign.
_BEFORE = (
    r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"\d-]++'
    r"|-?(?:0|[1-9]\d*+)(?:\.\d++)?+[eE][+-]?\d++|-?(?:0|[1-9]\d*+)(?![.\deE]))*+"
)
# Numbers one after the other; the first thing that is no JSON ends it, so that a text which doesn't parse stays one.
_FRACTION = rf"\G({_BEFORE})(-?(?:0|[1-9]\d*+)\.\d++)(?![.\deE]|[ \t\r\n]*+:)"


def is_marked(text: Column) -> Column:
    """Whether `as_written` marks the text's numbers: it may hold one with a fraction, and holds no mark itself."""
    holds_mark = text.contains(_MARK) | (text.contains("241") & text.rlike(r"\\[uU]241[dD]"))
    return text.contains(".") & text.rlike(r"\d\.\d") & ~holds_mark


def as_written(text: Column, marked: Column | None = None) -> Column:
    """The document with each number that has a fraction as a marked string. `marked` is `is_marked` where it is at hand."""
    return F.when(is_marked(text) if marked is None else marked, F.regexp_replace(text, _FRACTION, f'$1"{_MARK}$2"')).otherwise(text)


def written(value: Column, marked: Column) -> Column:
    """A member of a document, which was marked or not: numbers, also those within, are themselves again."""
    plain = F.regexp_replace(value, f'"{_MARK}([^"]*)"|^{_MARK}', "$1")
    return F.when(marked & value.contains(_MARK), plain).otherwise(value)

_PROPERTY_MEMBERS = ("categorypropertyallocationid", "value")
_PROPERTY = f"struct<{','.join(f'{m}:string' for m in _PROPERTY_MEMBERS)}>"


def _closed_list(text: Column) -> Column:
    closed = F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))
    return F.from_json(F.when(text.rlike(_START), closed), "array<string>", STRICT)


def _is_closed_list(found: Column) -> Column:
    return F.coalesce((F.size(found) == 2) & (F.get(found, F.lit(1)) == _END), F.lit(False))


def is_json(text: Column) -> Column:
    """The whole text is one JSON value. NULL and blank texts are not.

    The readers stop after the first value, so the text is placed in a list in
    front of a closing element: it is valid when exactly these two come back.
    Texts that cannot be JSON by their first character are not read at all.
    """
    return _is_closed_list(_closed_list(text))


def _closed_objects(text: Column, document: Column, fields: str) -> Column:
    """Reads `document`, which is `text` as written: both are objects or none is, and the plain text tells it at less cost."""
    closed = F.concat(F.lit("["), F.when(is_object(text), document), F.lit(f',{{"{_END}":"0"}}]'))
    return F.from_json(closed, f"array<struct<{fields},`{_END}`:string>>", STRICT)


def _is_closed_objects(found: Column) -> Column:
    return F.coalesce((F.size(found) == 2) & F.get(found, F.lit(1))[_END].isNotNull(), F.lit(False))


def is_object(text: Column) -> Column:
    """First character that counts is a brace. Says nothing on validity."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def json_or_null(text: Column) -> Column:
    """The text when it is valid JSON, else NULL."""
    return F.when(is_json(text), text)


def member(text: Column, name: str) -> Column:
    """One top-level member as text."""
    parsed = F.from_json(F.when(is_object(text), as_written(text)), f"struct<`{name}`:string>", STRICT)
    return written(parsed[name], is_marked(text))


def read_members(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Add top-level members as text, each under its name, as `member` gives them. The text is read once for all of them.

    Of a broken document the reader gives what came before; `_END` tells that it broke, and then there are no members.
    """
    fields = ",".join(f"`{name}`:string" for name in (*names, _END))
    document, found = F.when(is_object(F.col(column)), F.col("_document")), F.col("_found")
    whole = found[_END].isNull()
    return (
        rows.withColumn("_marked", is_marked(F.col(column)))
        .withColumn("_document", as_written(F.col(column), F.col("_marked")))
        .withColumn("_found", F.from_json(document, f"struct<{fields}>", {**STRICT, "columnNameOfCorruptRecord": _END}))
        .select(*rows.columns, *[F.when(whole, written(found[name], F.col("_marked"))).alias(name) for name in names])
    )


def read_documents(rows: DataFrame, column: str) -> DataFrame:
    """Add `document_ok` and `properties`, the array (id text, value text) under `propertiesBean`.

    `properties` is NULL when there is no such array. The text is read once,
    for its validity and its list. A list with elements that are no objects
    does not fit that read; such a document is read again element by element.
    """
    document = F.col("_document")
    found, direct = F.col("_found"), F.col("_direct")
    plain = F.transform(
        "properties", lambda p: F.when(p.isNotNull(), F.struct(*[written(p[c], F.lit(True)).alias(c) for c in _PROPERTY_MEMBERS]))
    )
    return (
        rows.withColumn("_marked", is_marked(F.col(column)))
        .withColumn("_document", as_written(F.col(column), F.col("_marked")))
        .withColumn("_found", _closed_objects(F.col(column), document, f"propertiesBean:array<{_PROPERTY}>"))
        .withColumn("_direct", _is_closed_objects(found))
        .withColumn("document_ok", F.when(direct, F.lit(True)).otherwise(is_json(document)))
        .withColumn(
            "properties",
            F.when(direct & F.get(found, F.lit(0))["propertiesBean"].isNotNull(), F.get(found, F.lit(0))["propertiesBean"])
            .when(F.col("document_ok"), _one_by_one(document)),
        )
        .withColumn("properties", F.when(F.col("_marked"), plain).otherwise(F.col("properties")))
        .drop("_marked", "_document", "_found", "_direct")
    )


def _one_by_one(document: Column) -> Column:
    text = F.when(is_object(document), document)
    elements = F.from_json(text, "struct<propertiesBean:array<string>>", STRICT)["propertiesBean"]
    return F.transform(elements, lambda e: F.from_json(F.when(is_object(e), e), _PROPERTY, STRICT))


def broken_document(column: str) -> Column:
    """Why a document cannot be used, after `read_documents`; NULL when it can."""
    document = F.col(column)
    keys = F.json_object_keys(F.when(is_object(document), document))
    names_list = F.coalesce(F.array_contains(keys, "propertiesBean"), F.lit(False))
    return F.when(document.isNotNull() & ~F.col("document_ok"), F.lit("document does not parse")).when(
        F.col("properties").isNull() & names_list, F.lit("properties are not a list")
    )


def open_value(text: Column) -> Column:
    """A value as read, for `value_ok` and `value_member`.

    Inside a lambda every mention of an expression is worked out again, so the
    read is kept in a field and everything else is taken from that field.
    """
    return F.struct(
        _closed_objects(text, as_written(text), "meter_Id:string,value:string,seal_number:string").alias("object"),
        is_marked(text).alias("marked"),
        _closed_list(F.when(~is_object(text), text)).alias("other"),
    )


def value_ok(opened: Column) -> Column:
    """The value was JSON."""
    return F.when(opened["object"].isNotNull(), _is_closed_objects(opened["object"])).otherwise(
        _is_closed_list(opened["other"])
    )


def value_member(opened: Column, name: str) -> Column:
    """Member of a value that was an object."""
    return written(F.get(opened["object"], F.lit(0))[name], opened["marked"])


def payload(columns: list[Column]) -> Column:
    """JSON text of the columns. NULL members stay in."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
