"""Text expressions: trimming, keys, aliases, URLs, light HTML, prompts."""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters SQL trim() removes (Unicode space separators),
# and the ones Python's str.strip() removes on top of those.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
ALL_WHITESPACE = SPACE_SEPARATORS + (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u2028\u2029"
)

# Aliases accepted for the two categorical fields of a reply.
SENIORITY_ALIASES = {
    "junior": "junior",
    "mid": "mid",
    "semi-senior": "mid",
    "semisenior": "mid",
    "intermedio": "mid",
    "senior": "senior",
}
WORK_MODE_ALIASES = {
    "remoto": "remoto",
    "remote": "remoto",
    "teletrabajo": "remoto",
    "hibrido": "hibrido",
    "híbrido": "hibrido",
    "hybrid": "hibrido",
    "presencial": "presencial",
    "on-site": "presencial",
    "onsite": "presencial",
    "on site": "presencial",
}
# Display order and labels of the work modes.
WORK_MODES = ["remoto", "hibrido", "presencial"]
WORK_MODE_LABELS = {"remoto": "Remoto", "hibrido": "Híbrido", "presencial": "Presencial"}


def sql_trim(c: Column) -> Column:
    """Trim as SQL ``trim`` does: every Unicode space separator, no control characters."""
    return F.btrim(c, F.lit(SPACE_SEPARATORS))


def strip(c: Column) -> Column:
    """Trim all whitespace, including tabs and line breaks."""
    return F.btrim(c, F.lit(ALL_WHITESPACE))


def term_key(c: Column) -> Column:
    """Catalogue key of a term in the SQL models: trim, collapse spaces, lower."""
    return F.lower(F.regexp_replace(sql_trim(c), r"[ \t\n\f\r]+", " "))


def entry_key(c: Column) -> Column:
    """Catalogue key of a term on the loading side, where any Unicode space counts.

    Nearly all terms have single plain spaces between words, so one search decides whether the rest is needed.
    """
    odd = ALL_WHITESPACE.replace(" ", "")
    full = F.regexp_replace(F.lower(strip(c)), f"[{ALL_WHITESPACE}]+", " ")
    return F.when(F.rlike(c, F.lit(f"[{odd}]|  ")), full).otherwise(F.lower(F.trim(c)))


def surrogate_key(*parts: Column) -> Column:
    """``a|b|...``; NULL as soon as one part is NULL."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("|"), part]
    return F.concat(*pieces)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def canonical_level(c: Column) -> Column:
    """Lower-cased, trimmed value; blank becomes NULL."""
    return blank_to_null(F.lower(sql_trim(c)))


def canonical_mode(c: Column) -> Column:
    """Like ``canonical_level``, without the accent of ``híbrido``."""
    return F.replace(canonical_level(c), F.lit("í"), F.lit("i"))


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of a key in a dictionary that travels in the plan as one constant.

    Map lookups scan their keys, so the entries are spread over as many buckets by
    checksum and a lookup reads one bucket.
    """
    size = max(len(mapping), 1)
    buckets: list[dict[str, str]] = [{} for _ in range(size)]
    for k, v in mapping.items():
        buckets[zlib.crc32(k.encode()) % size][k] = v
    table = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), "array<map<string,string>>")
    # the key is evaluated once, although it chooses the bucket and the entry
    found = F.transform(
        F.array(key), lambda k: F.try_element_at(F.get(table, (F.crc32(k) % size).cast("int")), k)
    )
    return F.get(found, F.lit(0))


def alias_map(c: Column, aliases: dict[str, str]) -> Column:
    """Canonical category of a text, or NULL when it is no known alias."""
    return lookup(aliases, F.lower(strip(c)))


def label_map(c: Column, labels: dict[str, str]) -> Column:
    return lookup(labels, c)


def fixed_rank(c: Column, order: list[str]) -> Column:
    """Zero-based position of a value in a fixed order, NULL when absent."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), c).cast("int")
    return F.nullif(position, F.lit(0)) - 1


def clean_url(c: Column) -> Column:
    """URL without query and fragment; blank becomes NULL."""
    bare = F.translate(F.btrim(c, F.lit("".join(map(chr, range(33))))), "\t\r\n", "")
    bare = F.regexp_replace(bare, r"(?s)[?#].*$", "")
    scheme = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0)
    lowered = F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1))
    return F.when(blank_to_null(c).isNotNull(), lowered)


_BREAK = "\u0001"
# Outside quotes a tag ends at the next angle bracket, so each piece of text is read once.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^<>]*>.*?(?:</\1\s*>|\z)"
_TAG = r"""<[/!?A-Za-z](?:[^'"<>]++|"[^"]*+"|'[^']*+')*+>"""
# Numeric references 128 to 159 mean the characters of this code page; its gaps stay as they are.
_LATIN = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]


def _code_point(digits: Column, base: int) -> Column:
    """Character of a code point written in ``base``; NULL when there is none."""
    code = F.conv(digits, base, 10).cast("int")
    usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    wide = F.lpad(F.hex(F.when(usable, code).otherwise(32)), 8, "0")
    latin = F.get(F.array(*map(F.lit, _LATIN)), code - 128)
    return F.when(code.between(128, 159), latin).when(usable, F.decode(F.unhex(wide), "UTF-32"))


def unescape(c: Column) -> Column:
    """Decode character references (``&amp;``, ``&eacute;``, ``&#233;``, ``&#xE9;``).

    The semicolon is optional; an unknown name stays as it is, without it.
    """
    named = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^([A-Za-z][-.A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6})", 1)
        rest = F.regexp_replace(F.substr(piece, F.length(name) + 1), "^;", "")
        value = (
            F.when(F.rlike(name, F.lit("^#[0-9]")), _code_point(F.substr(name, F.lit(2)), 10))
            .when(F.rlike(name, F.lit("^#[xX]")), _code_point(F.substr(name, F.lit(3)), 16))
            .otherwise(lookup(named, name))
        )
        known = F.concat(F.coalesce(value, F.concat(F.lit("&"), name)), rest)
        return F.when(name != "", known).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(c, "&")
    tail = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(tail, decode), ""))
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def html_text(c: Column) -> Column:
    """Visible text of light HTML: text nodes stripped, blanks dropped, joined by a space."""
    text = F.regexp_replace(F.regexp_replace(c, _HIDDEN, _BREAK), _TAG, _BREAK)
    nodes = F.transform(F.split(text, _BREAK), lambda node: strip(unescape(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), " ")


# Default wording; {titulo} and {descripcion} are filled per offer. Callers with
# their own wording pass a template and raise their prompt version.
DEFAULT_TEMPLATE = """Eres un lector de anuncios de trabajo. Devuelve un único objeto JSON, sin texto alrededor, con:
"tecnologias": lista con cada herramienta técnica nombrada; [] cuando no se nombra ninguna.
"seniority": "junior", "mid" o "senior"; null si el anuncio calla.
"modalidad": "remoto", "hibrido" o "presencial"; null si el anuncio calla.
"salario_min", "salario_max": bruto anual en euros, en cifras; null si el anuncio calla.
Cíñete a lo escrito.

Puesto: {titulo}

Texto del anuncio:
{descripcion}
"""


def prompt(
    title: Column,
    description: Column,
    template: str = DEFAULT_TEMPLATE,
    max_chars: int | None = None,
) -> Column:
    """Prompt of an offer: NULLs read as empty text, description cut at ``max_chars`` if given."""
    head, rest = template.split("{titulo}", 1)
    middle, tail = rest.split("{descripcion}", 1)
    body = F.coalesce(description, F.lit(""))
    if max_chars is not None:
        body = F.substring(body, 1, max_chars)
    return F.concat(F.lit(head), F.coalesce(title, F.lit("")), F.lit(middle), body, F.lit(tail))
