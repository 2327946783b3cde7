"""Column helpers for XML text that is read tag by tag."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import all_matches, let

# The attribute part of a start tag; quoted values may hold '>'.
ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
MASK = "\uffff"
COMMENT_OR_CDATA = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"


def without_opaque_parts(xml: Column) -> Column:
    """Drop comments and CDATA; a ``<`` left in well-formed text then starts a tag."""
    cut = F.regexp_replace(xml, COMMENT_OR_CDATA, "")
    return F.when(F.contains(xml, F.lit("<!")), cut).otherwise(xml)


def masked(xml: Column) -> Column:
    """The text with every ``<`` inside a comment or CDATA section as U+FFFF, which no XML text may hold.

    A ``<`` that is left starts a tag, and nothing is lost (:func:`unmasked`).
    """
    parts = F.split(xml, COMMENT_OR_CDATA, -1)
    opaque = F.transform(all_matches(xml, COMMENT_OR_CDATA), lambda x: F.replace(x, F.lit("<"), F.lit(MASK)))
    joined = F.zip_with(parts, opaque, lambda part, x: F.concat(part, F.coalesce(x, F.lit(""))))
    return F.when(F.contains(xml, F.lit("<!")), F.array_join(joined, "")).otherwise(xml)


def unmasked(text: Column) -> Column:
    return F.replace(text, F.lit(MASK), F.lit("<"))


def own_text(text: Column) -> Column:
    """The character data in a masked piece of text: comments go, CDATA is taken as it is, entities are resolved."""
    bare = F.regexp_replace(text, rf"(?s){MASK}!--.*?-->", "")
    cdata = rf"(?s){MASK}!\[CDATA\[(.*?)\]\]>"
    joined = F.zip_with(
        F.transform(F.split(bare, cdata, -1), unescape), all_matches(bare, cdata, 1), lambda part, x: F.concat(part, unmasked(F.coalesce(x, F.lit(""))))
    )
    return F.when(F.contains(bare, F.lit(MASK)), F.array_join(joined, "")).otherwise(unescape(bare))


def prefix_sums(values: Column) -> Column:
    """The running sums of an array of numbers.

    In each of ``log2(n)`` passes an element adds the one 1, 2, 4, ... places before it, so no pass depends on
    the element before and nothing is copied more than that often.
    """

    def sums(own: Column) -> Column:
        passes = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(own), F.lit(2)))).cast("int") - 1)
        shifted = lambda acc, k: F.slice(F.concat(F.array_repeat(F.lit(0), k), acc), F.lit(1), F.size(own))
        step = lambda acc, i: F.zip_with(acc, shifted(acc, F.power(F.lit(2), i).cast("int")), lambda a, b: a + b)
        return F.aggregate(passes, own, step)

    return let(values, sums)


def root_name(mask: Column) -> Column:
    """The name of the first tag of a masked text."""
    return F.regexp_extract(mask, r"<([^\s/>?!]+)", 1)


def tag_steps(tags: Column) -> Column:
    """What each tag adds to the depth: 1, -1, or 0 for an empty element."""
    return F.transform(tags, lambda tag: F.when(tag.startswith("</"), -1).when(tag.endswith("/>"), 0).otherwise(1))


def well_formed(xml: Column, mask: Column) -> Column:
    """Whether a text is one well-formed document; ``mask`` is the same text masked.

    The parser of the engine reads up to the end of the first element: names, nesting, attributes, entities and
    characters.  What it does not see is checked here: nothing but comments and instructions may follow, the first
    element must not end before its last tag, and prefixes must be declared.  Entities that a document declares
    itself are not accepted.
    """
    read = F.from_xml(xml, F.lit("_none STRING, _corrupt_record STRING"), {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = let(read, lambda doc: doc.isNotNull() & doc["_corrupt_record"].isNull())
    name = root_name(mask)

    def ended(root: Column) -> Column:
        # the tags of the root's name: it ends where their depth is 0 for the first time
        pattern = F.concat(F.lit("<(?:/"), F.regexp_replace(root, r"([.$])", r"\\$1"), F.lit(r"\s*|"), F.regexp_replace(root, r"([.$])", r"\\$1"), F.lit(rf"(?=[\s/>]){ATTRIBUTES})>"))
        tags = F.regexp_extract_all(mask, pattern, F.lit(0))
        once = let(tags, lambda x: (F.size(x) <= 2) | (F.array_position(prefix_sums(tag_steps(x)), F.lit(0)) == F.size(x)))
        behind = F.get(F.reverse(F.split(mask, pattern, -1)), F.lit(0))
        return once & behind.rlike(rf"(?s)^(?:[ \t\r\n]|{MASK}!--.*?-->|<\?(?!(?i:xml)\s).*?\?>)*$") & ((F.size(tags) != 2) | ~F.get(tags, F.lit(0)).endswith("/>"))

    prefixes = all_matches(mask, r"<([\p{L}_][\w.-]*):", 1)
    declared = F.forall(F.array_distinct(prefixes), lambda p: F.contains(mask, F.concat(F.lit("xmlns:"), p, F.lit("="))) | (p == "xml"))
    checked = F.when(parsed, let(name, ended) & F.when(F.contains(mask, F.lit(":")), declared).otherwise(True) & ~F.contains(xml, F.lit(MASK))).otherwise(F.lit(False))
    return F.coalesce(checked, F.lit(False))


def unescape(col: Column) -> Column:
    """Resolve the five named entities and numeric character references."""
    refs = F.array_distinct(all_matches(col, r"&#(?:\d+|x[0-9a-fA-F]+);"))
    code = lambda ref: F.when(
        ref.startswith("&#x"), F.conv(F.substring(ref, F.lit(4), F.length(ref) - 4), 16, 10)
    ).otherwise(F.substring(ref, F.lit(3), F.length(ref) - 3))
    char = lambda ref: F.decode(
        F.unhex(F.lpad(F.hex(code(ref).try_cast("bigint")), 8, "0")), "UTF-32"
    )
    numeric = F.aggregate(refs, col, lambda text, ref: F.replace(text, ref, char(ref)))
    out = F.when(F.contains(col, F.lit("&#")), numeric).otherwise(col)
    for entity, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(value))
    return out


def escape(col: Column) -> Column:
    out = col
    for value, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(value), F.lit(entity))
    return out


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in a start tag; NULL when the tag has none."""
    quoted = F.regexp_extract(tag, rf"""[\s]{name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    inner = lambda found: F.substring(found, F.lit(2), F.length(found) - 2)
    plain = lambda found: F.when(F.contains(found, F.lit("&")), unescape(inner(found))).otherwise(inner(found))
    # searched once: unescaping reads its text many times
    return let(quoted, lambda found: F.when(found != "", plain(found)))
