"""String helpers as Column expressions (JVM-side, inside whole-stage codegen).

Whitespace is the set that ``str.strip()`` and ``str.split()`` know, Unicode
spaces among them; patterns name it as a class, because ``\\s`` differs between
regex engines.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as removed by strip()/split() on text.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
            "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
WS_RANGES = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
WS_CLASS = f"[{WS_RANGES}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Both-ends whitespace strip (``str.strip()``; Spark's ``trim`` only drops spaces)."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """``' '.join(s.split())``: runs of whitespace to one space, ends stripped."""
    return strip(F.regexp_replace(col(c), WS_CLASS + "+", " "))


def nz(c: Column | str) -> Column:
    """null -> '' (the reference fills every scanned null with an empty string)."""
    return F.coalesce(col(c), F.lit(""))


def split_title(text: Column | str) -> tuple[Column, Column]:
    """Split free text into (title, abstract): the title is the first sentence
    (up to and including the first ``.``, ``!`` or ``?``, or up to the first
    newline), the abstract is the rest, both stripped."""
    t = nz(text)
    head = F.regexp_extract(t, r"^[^.!?\n]*[.!?]?", 0)
    rest = F.substring(t, F.length(head) + 1, 1 << 30)
    return strip(head), strip(rest)


def doc_text(pmid: Column | str, title: Column | str, abstract: Column | str) -> Column:
    """The encoder input ``PMID: …\\nTITLE: …\\nABSTRACT: …``, stripped."""
    return strip(F.concat(F.lit("PMID: "), nz(pmid), F.lit("\nTITLE: "), nz(title),
                          F.lit("\nABSTRACT: "), nz(abstract)))


def snippet_head_tail(abstract: Column | str, width: int = 650) -> Column:
    """First ``width`` chars, plus ``\\n...\\n`` and the last ``width`` chars
    when longer (the two windows overlap below 2*width chars)."""
    a = nz(abstract)
    long_form = strip(F.concat(F.substring(a, 1, width), F.lit("\n...\n"),
                               F.substring(a, -width, width)))
    return F.when(F.length(a) > width, long_form).otherwise(a)


def snippet_words(abstract: Column | str, width: int = 550, placeholder: str = "…") -> Column:
    """Shorten to ``width`` chars at a word break, ending in ``placeholder``.

    Whitespace is collapsed first; text that fits is returned as is; otherwise
    the longest whole-word prefix that leaves room for the placeholder is kept
    (a single word longer than that is cut).  Breaks only at spaces, not after
    hyphens (documented choice).
    """
    s = collapse_ws(abstract)
    room = width - len(placeholder)
    words = F.regexp_extract(s, rf"(?s)^(.{{0,{room - 1}}}[^ ]) ", 1)
    cut = F.when(words == "", F.substring(s, 1, room)).otherwise(words)
    return F.when(F.length(s) <= width, s).otherwise(F.concat(cut, F.lit(placeholder)))


# The named character references decoded in markup text.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def decode_entities(c: Column | str) -> Column:
    out = col(c)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def markup_text(fragment: Column | str) -> Column:
    """Text of a markup fragment the way ``get_text(" ", strip=True)`` gives it:
    the text nodes in document order, each stripped, empties dropped, joined
    by one space; character references decoded per node."""
    nodes = F.split(nz(fragment), r"<[^>]*>", -1)
    cleaned = F.transform(nodes, lambda n: strip(decode_entities(n)))
    return F.array_join(F.filter(cleaned, lambda n: n != ""), " ")
