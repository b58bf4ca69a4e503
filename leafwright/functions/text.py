"""String helpers that follow the text rules of a Python script on the JVM side.

Page rules are written against Unicode whitespace, ``\\n`` as the only line end
for ``.``, ``^`` and ``$``, and code-point lengths.  :func:`pattern` puts the
matching Java flags on a regular expression, so the rest of the package can
write plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# The line ends at which a text is cut to lines.
LINE_BREAK_CHAR = r"[\n\x0B\x0C\r\x1C-\x1E\x85\x{2028}\x{2029}]"
OTHER_LINE_BREAK_CHAR = LINE_BREAK_CHAR.replace(r"\n", "")
LINE_BREAK = r"\r\n|" + LINE_BREAK_CHAR


def pattern(regex: str, flags: str = "") -> str:
    """Add the Java flags that give ``regex`` Unicode classes and ``\\n`` line ends.

    ``flags`` takes any of ``m`` (``^``/``$`` per line), ``s`` (dot takes
    newlines) and ``i`` (ignore case).
    """
    body = regex.replace(r"\S", r"[^\s\x1C-\x1F]")
    out, i = [], 0
    while i < len(body):
        pair = body[i : i + 2]
        if pair == r"\s" and not body.startswith(r"\s\x1C-\x1F", i):
            out.append(r"[\s\x1C-\x1F]")
            i += 2
        elif pair[:1] == "\\":
            out.append(pair)
            i += 2
        else:
            out.append(body[i])
            i += 1
    return f"(?dU{flags})" + "".join(out)


def pytrim(col: Column) -> Column:
    """Trim all Unicode whitespace (``trim`` takes spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def unquote_value(col: Column) -> Column:
    """Trim whitespace, then any run of quotes at both ends."""
    return F.btrim(pytrim(col), F.lit("\"'"))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value worked out once, however often ``fn`` names it.

    A column is an expression, so using it n times writes it out n times, and
    nested steps multiply.  A lambda variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def _without_last_break(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?:{LINE_BREAK})\z", "")


def split_lines(col: Column) -> Column:
    """Lines of a text; a final line end does not make one more empty line."""
    return F.split(_without_last_break(col), LINE_BREAK, -1)


def single_line(col: Column) -> Column:
    """Join the lines of a text with one space."""
    return F.regexp_replace(_without_last_break(col), LINE_BREAK, " ")


def normalise_lines(col: Column) -> Column:
    """Join the lines of a text with ``\\n`` (no line end at the end)."""

    def joined(text: Column) -> Column:
        # Where ``\\n`` is the only line end, all but the last stay as they are.
        plain = F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
        other = F.regexp_replace(_without_last_break(text), LINE_BREAK, "\n")
        return F.when(F.rlike(text, F.lit(OTHER_LINE_BREAK_CHAR)), other).otherwise(plain)

    return let(col, joined)


def drop_first_line(col: Column) -> Column:
    """Text without its first line, other lines joined with ``\\n``."""

    def rest(text: Column) -> Column:
        end = F.locate("\n", text)
        return F.when(end == 0, F.lit("")).otherwise(F.substr(text, end + 1))

    return let(normalise_lines(col), rest)


def truncate_text(col: Column, limit: int, marker: str = "\n...[truncated]") -> Column:
    """Cut a text to ``limit`` characters and say so."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit(marker))).otherwise(col)


def title_case(col: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    word = r"[\p{L}]+"
    return replace_matches(
        col, word, lambda m: F.concat(F.upper(F.substring(m, 1, 1)), F.lower(F.substring(m, 2, 1 << 30)))
    )


def replace_matches(col: Column, regex: str | Column, fn: Callable[[Column], Column]) -> Column:
    """Replace every match of ``regex`` by ``fn(match)``.

    Java replacement strings cannot call functions.  The text is cut at the
    matches and joined again with the new pieces: one pass, however many
    matches a text holds.
    """
    regex_col = F.lit(regex) if isinstance(regex, str) else regex

    def changed(text: Column) -> Column:
        pieces = F.split(text, regex_col, -1)
        fresh = F.transform(F.regexp_extract_all(text, regex_col, F.lit(0)), fn)
        joined = F.array_join(F.zip_with(pieces, fresh, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
        return F.when(F.rlike(text, regex_col), joined).otherwise(text)

    return let(col, changed)


def quote_regex(col: Column) -> Column:
    """A column's text as a literal inside a regular expression."""
    return F.concat(F.lit(r"\Q"), col, F.lit(r"\E"))


def percent_decode(col: Column) -> Column:
    """Decode each run of ``%xx``; ``+`` and bad escapes stay as they are."""
    return replace_matches(col, r"(?:%[0-9A-Fa-f]{2})+", lambda m: F.coalesce(F.try_url_decode(m), m))


def strip_markup(col: Column) -> Column:
    """Drop comments, script and style blocks, and tags."""
    no_blocks = F.regexp_replace(
        col, pattern(r"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "is"), ""
    )
    return F.regexp_replace(no_blocks, r"<[A-Za-z/!?][^>]*+>", "")


# What code points 128 to 159 stand for in numbered entities, by the rule of browsers: Windows-1252 where it has a sign.
_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160))
_CUT = "\x01"


def _named(names: dict[str, str]) -> Column:
    """A map literal; Spark folds it once for each plan."""
    return F.map_from_arrays(F.split(F.lit(_CUT.join(names)), _CUT), F.split(F.lit(_CUT.join(names.values())), _CUT))


def decode_entities(col: Column) -> Column:
    """Decode markup entities, named and numbered, with or without the closing semicolon, as browsers do."""
    known = _named(html5)
    # Names that need no semicolon also count in front of other letters; the longest goes first.
    open_names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    head = f"^({'|'.join(open_names)})"

    def numbered(body: Column) -> Column:
        hexadecimal = body.rlike("^#[xX]")
        digits = F.regexp_extract(body, "^#[xX]?0*([0-9a-fA-F]*)", 1)
        short = F.concat(F.lit("0"), F.substring(digits, 1, 8))
        number = F.when(hexadecimal, F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10)).cast("bigint")

        def sign(n: Column) -> Column:
            low = n.between(1, 8) | n.between(14, 31) | n.isin(11, 127)
            none = low | n.between(0xFDD0, 0xFDEF) | (n % 65536).isin(0xFFFE, 0xFFFF)
            plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
            wrong = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF) | (F.length(digits) > 8)
            return (
                F.when(wrong, "\ufffd")
                .when(n.between(128, 159), F.substring(F.lit(_WINDOWS), (n - 127).cast("int"), F.lit(1)))
                .when(none, "")
                .otherwise(plain)
            )

        return let(number, sign)

    def decoded(match: Column) -> Column:
        body = F.substring(match, 2, 1 << 30)
        start = F.regexp_extract(body, head, 1)
        rest = F.substring(body, F.length(start) + 1, F.lit(1 << 30))
        return (
            F.when(body.startswith("#"), numbered(body))
            .when(F.map_contains_key(known, body), F.try_element_at(known, body))
            .when(start != "", F.concat(F.try_element_at(known, start), rest))
            .otherwise(match)
        )

    entity = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
    return replace_matches(col, entity, decoded)


def html_to_text(col: Column) -> Column:
    """Plain text of markup."""
    return decode_entities(strip_markup(col))
