"""Expressions over extraction replies: JSON that may be broken, fenced or wrapped in prose."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closes the probes below; a reply never contains it.
_END = "end of the reply"
_FENCE = "```"


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated a single time, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strict_json(c: Column) -> Column:
    """Variant of a text that is one whole JSON value, else NULL.

    The parser stops at the end of the first value, so the text is parsed as the
    first element of an array with a known second one: trailing text breaks it.
    """
    probe = F.try_parse_json(F.concat(F.lit("["), c, F.lit(f',"{_END}"]')))
    return once(
        probe,
        lambda p: F.when(
            F.try_variant_get(p, "$[1]", "string") == _END, F.try_variant_get(p, "$[0]", "variant")
        ),
    )


def kind(v: Column) -> Column:
    """Type name of a variant: OBJECT<..>, ARRAY<..>, STRING, BOOLEAN, VOID, ..."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.startswith(kind(v), F.lit("OBJECT"))


def unfenced(c: Column) -> Column:
    """A reply without a leading code fence and its language, and without a closing one."""
    blanks = F.lit(" \t\r\n\f")

    def opened(t: Column) -> Column:
        body = F.substr(t, F.lit(len(_FENCE) + 1))
        body = F.when(F.startswith(body, F.lit("json")), F.substr(body, F.lit(5))).otherwise(body)
        return F.btrim(F.when(F.startswith(t, F.lit(_FENCE)), body).otherwise(t), blanks)

    def closed(t: Column) -> Column:
        body = F.left(t, F.length(t) - len(_FENCE))
        return F.btrim(F.when(F.endswith(t, F.lit(_FENCE)), body).otherwise(t), blanks)

    return once(once(F.btrim(c, blanks), opened), closed)


def reply_fields(c: Column, *names: str) -> Column:
    """``(is_object, fields: (<names>: VARIANT))`` of a reply without its code fences, else of its outermost braces.

    Only the named fields are kept; of repeated keys the last wins. NULL when nothing parses.
    """
    kept = "STRUCT<" + ", ".join(f"`{n}`: VARIANT" for n in names) + ">"

    def parsed(text: Column) -> Column:
        probe = F.from_json(
            F.concat(F.lit('{"reply":'), text, F.lit(f',"end":"{_END}"}}')),
            f"reply {kept}, end STRING",
            {"allowSingleQuotes": "false"},
        )
        return once(probe, lambda p: F.when(p["end"] == _END, p["reply"]))

    def of(bare: Column) -> Column:
        opens = F.startswith(bare, F.lit("{"))
        inner = once(F.regexp_extract(bare, r"(?s)\{.*\}", 0), lambda t: F.when(t != "", parsed(t)))
        whole = F.when(opens, parsed(bare))
        # any other value; prose is not worth a failing parse
        other = F.when(~opens & F.rlike(bare, F.lit(r'^(?:[\["0-9-]|true|false|null)')), strict_json(bare))
        plain = once(other, lambda v: F.when(v.isNotNull(), F.struct(F.lit(False).alias("is_object"), F.lit(None).cast(kept).alias("fields"))))
        found = once(F.coalesce(whole, F.when(plain.isNull(), inner)), lambda r: F.when(
            r.isNotNull(), F.struct(F.lit(True).alias("is_object"), r.alias("fields"))
        ))
        return F.coalesce(plain, found)

    return once(unfenced(F.coalesce(c, F.lit(""))), of)


def json_list(c: Column, name: str) -> Column:
    """Array of strings under ``name`` in a text that is one whole JSON object, else NULL.

    Parses that one field only. Elements of other types become their JSON text.
    """
    bare = F.btrim(c, F.lit(" \t\r\n"))
    probe = F.from_json(
        F.concat(F.lit('{"reply":'), bare, F.lit(f',"end":"{_END}"}}')),
        f"reply STRUCT<`{name}`: ARRAY<STRING>>, end STRING",
        {"allowSingleQuotes": "false"},
    )
    # texts without braces are not worth a failing parse
    braced = F.startswith(bare, F.lit("{")) & F.endswith(bare, F.lit("}"))
    return F.when(braced, once(probe, lambda p: F.when(p["end"] == _END, p["reply"][name])))


def text_items(obj: Column, path: str) -> Column:
    """The string elements of the list at ``path``; other types are dropped, no list is []."""
    items = F.try_variant_get(obj, path, "array<variant>")
    texts = F.transform(
        F.filter(items, lambda v: kind(v) == "STRING"), lambda v: F.variant_get(v, "$", "string")
    )
    return F.coalesce(texts, F.array().cast("array<string>"))


def text_field(obj: Column, path: str) -> Column:
    """The value at ``path`` when it is a JSON string, else NULL."""
    return once(
        F.try_variant_get(obj, path, "variant"),
        lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string")),
    )


def salary_text(c: Column) -> Column:
    """Number in a salary text: digits, dots and commas only; dots group, a comma is decimal."""
    kept = F.translate(F.regexp_replace(c, r"[^0-9.,]", ""), ",.", ".")
    return kept.try_cast("double")


def lenient_salary(obj: Column, path: str) -> Column:
    """Positive salary at ``path``: a number, or a text such as ``45.000 €``."""

    def number(v: Column) -> Column:
        text = F.try_variant_get(v, "$", "string")
        return (
            F.when(kind(v) == "STRING", salary_text(text))
            .when(kind(v) != "BOOLEAN", F.try_variant_get(v, "$", "double"))
        )

    found = once(F.try_variant_get(obj, path, "variant"), number)
    return once(found, lambda n: F.when((n > 0) & ~F.isnan(n), n))
