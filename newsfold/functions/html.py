"""Column functions for HTML (inventory F1, F2, F3).

A page is cut into units, a tag and the text after it, and read by a fold over
its tags that carries the open elements, newest first.  An end tag closes the
newest open element of its name and everything opened inside it; one that
matches no open element is ignored; elements still open at the end end there.

F1 (fallback text): drop script/style/noscript/svg/header/footer/nav elements
with their content and comments, turn every remaining tag into a space, decode
entities, collapse whitespace.  The <title> text is part of the result.  A
dropped element may be nested in itself, be left open, or end with an element around it.

F2 (main content, our definition after scoring extractors of the readability
kind): a text hands the number of its words, words inside links counted
negative, to the block element it stands in and to that one's parent in full and to its
grandparent by half; the element of the greatest sum, if it reaches
``MAIN_MIN_WORDS`` words, is the main content, the inner one on ties.

All of it is array higher-order functions inside one row: no explode, no
shuffle.  A fold keeps the open elements and what it has found so far, not a
value per unit, so its cost is the number of tags times their depth.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .common import col as _c
from .common import let
from .text import normalize_ws


#: Any tag; a '>' inside a quoted attribute does not end it.  The '<' stands once, so that text between tags is passed by one test a character.
TAG_RE = r"""<(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*>)"""


def open_tag(name: str) -> str:
    """Pattern of an opening tag; the name ends where the tag's name ends, so a
    custom element such as <nav-bar> is another element."""
    return rf"<{name}(?:[\s/][^>]*)?>"


def _named_entities() -> Column:
    """Names (without '&' and ';') to characters, from the standard library's HTML 5 table."""
    pairs = (f"{name[:-1]}\x01{chars}" for name, chars in html5.items() if name.endswith(";"))
    return F.str_to_map(F.lit("\x02".join(pairs)), F.lit("\x02"), F.lit("\x01"))


def _code_point(n: Column) -> Column:
    """The character of a code point; U+FFFD for what is none."""
    n = n.cast("long")
    fine = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def decode_entities(col) -> Column:
    """Character references replaced in one pass, so that decoded text is not decoded again; a name that is
    none stays as it is."""
    names = _named_entities()

    def decoded(piece: Column) -> Column:
        def named(ref: Column) -> Column:
            text = (
                F.when(ref == "", F.lit(None))
                .when(F.lower(F.substring(ref, 1, 2)) == "#x", _code_point(F.conv(F.substring(ref, 3, 6), 16, 10)))
                .when(ref.startswith("#"), _code_point(F.substring(ref, 2, 7)))
                .otherwise(F.try_element_at(names, ref))
            )
            return F.coalesce(F.concat(text, F.substr(piece, F.length(ref) + F.lit(3))), piece)

        return let(F.regexp_extract(piece, K.ENTITY_RE, 1), named)

    text = _c(col)
    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "(?=&)"), decoded), "")).otherwise(text)


#: Comments, and elements whose content is not HTML; they end at their end tag or with the page.
RAW_RE = r"(?is)<(?:!--.*?(?:-->|\z)" + "".join(rf"|{open_tag(t).removeprefix('<')}.*?(?:</{t}\s*>|\z)" for t in ("script", "style")) + ")"
NAME_RE = r"^</?([A-Za-z][^\s/>]*)"

OTHER, OPENS, CLOSES = 0, 1, 2


def _units(html: Column) -> Column:
    return F.split(html, f"(?={TAG_RE})", -1)


def _tag(unit: Column) -> Column:
    """name of the unit's tag, and whether it opens or closes an element."""

    def kind(name: Column) -> Column:
        empty = name.isin(*K.VOID_ELEMENTS) | unit.rlike(r"^<[^>]*/>")
        op = F.when(name == "", OTHER).when(unit.startswith("</"), CLOSES).when(empty, OTHER).otherwise(OPENS)
        return F.struct(name.alias("name"), op.alias("op"))

    return let(F.lower(F.regexp_extract(unit, NAME_RE, 1)), kind)


def _pushed(stack: Column, value: Column) -> Column:
    return F.concat(F.array(value), stack)


def _rest(stack: Column, n: Column) -> Column:
    """The stack without its newest n."""
    return F.slice(stack, n + F.lit(1), F.size(stack))


def _dropped_spans(tags: Column) -> Column:
    """Units [a, b) inside dropped elements, as a flat array a, b, a, b ...; an element left open has no b."""
    # elements that nothing closes by name need not be carried
    closed = F.array_distinct(F.transform(F.filter(tags, lambda t: t["op"] == CLOSES), lambda t: t["name"]))

    def walk(names_closed: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("i"), F.array().cast("array<string>").alias("names"), F.lit(-1).alias("since"), F.array().cast("array<int>").alias("gone")
        )

        def step(acc: Column, tag: Column) -> Column:
            name, names, inside, i = tag["name"], acc["names"], acc["since"] >= 0, acc["i"]
            at = F.when(tag["op"] == CLOSES, F.array_position(names, name)).otherwise(F.lit(0)).cast("int")
            begins = (tag["op"] == OPENS) & name.isin(*K.DROPPED_ELEMENTS) & ~inside
            carried = (tag["op"] == OPENS) & (F.array_contains(names_closed, name) | name.isin(*K.DROPPED_ELEMENTS))
            # since is the depth below the outermost dropped element; it ends when the stack falls to that
            ends = inside & (at > 0) & (F.size(names) - at <= acc["since"])
            return F.struct(
                (i + F.lit(1)).alias("i"),
                F.when(carried, _pushed(names, name)).when(at > 0, _rest(names, at)).otherwise(names).alias("names"),
                F.when(begins, F.size(names)).when(ends, F.lit(-1)).otherwise(acc["since"]).alias("since"),
                F.when(begins | ends, F.concat(acc["gone"], F.array(i))).otherwise(acc["gone"]).alias("gone"),
            )

        return F.aggregate(tags, start, step, lambda acc: acc["gone"])

    return let(closed, walk)


def strip_dropped_elements(col) -> Column:
    """Remove comments and the dropped elements with their content; their end tags stay as tags."""
    html = F.regexp_replace(F.coalesce(_c(col), F.lit("")), RAW_RE, " ")

    def kept(units: Column) -> Column:
        def around(gone: Column) -> Column:
            n = F.size(units)
            edge = lambda k, default: F.coalesce(F.get(gone, k), default)
            spans = F.transform(
                F.sequence(F.lit(0), F.floor(F.size(gone) / 2).cast("int")),
                lambda k: let(
                    F.struct(F.when(k == 0, F.lit(0)).otherwise(edge(2 * k - 1, n)).alias("a"), edge(2 * k, n).alias("b")),
                    lambda s: F.slice(units, s["a"] + F.lit(1), F.greatest(s["b"] - s["a"], F.lit(0))),
                ),
            )
            return F.array_join(F.flatten(spans), "")

        return let(let(F.transform(units, _tag), _dropped_spans), around)

    return let(_units(html), kept)


def tags_to_text(col) -> Column:
    """Every tag becomes a space; entities decoded; X1."""
    return normalize_ws(decode_entities(F.regexp_replace(_c(col), TAG_RE, " ")))


def html_title(col) -> Column:
    """Text of the first <title> element, entities decoded, X1.  Applied to
    the raw HTML: the title sits at the top, so the search stops early."""
    raw = F.regexp_extract(F.coalesce(_c(col), F.lit("")), rf"(?is){open_tag('title')}(.*?)</title\s*>", 1)
    return tags_to_text(raw)


def html_text(cleaned_html) -> Column:
    """F1 on HTML already passed through :func:`strip_dropped_elements`."""
    return tags_to_text(cleaned_html)


def _best_block(units: Column) -> Column:
    """score (of half words), a, b: the units [a, b) of the element that its texts give the most."""
    def seen(unit: Column) -> Column:
        words = F.regexp_count(F.regexp_replace(unit, f"^(?:{TAG_RE})", ""), F.lit(r"[^ \t\n\x0B\f\r]+"))
        return let(_tag(unit), lambda t: F.struct(t["name"].alias("name"), t["op"].alias("op"), words.alias("words")))

    start = F.struct(
        F.lit(0).alias("i"),
        F.lit(False).alias("linked"),
        F.array(F.lit("")).alias("names"),
        F.array(F.lit(0)).alias("starts"),
        F.array(F.lit(0)).alias("scores"),
        F.struct(F.lit(0).alias("score"), F.lit(0).alias("a"), F.lit(0).alias("b")).alias("best"),
    )

    def better(best: Column, scores: Column, starts: Column, n: Column, end: Column) -> Column:
        """best, or the newest of the first n elements with a greater score."""
        top = F.array_max(F.slice(scores, 1, n))
        own = F.struct(top.alias("score"), F.element_at(starts, F.array_position(scores, top).cast("int")).alias("a"), end.alias("b"))
        return F.when(F.coalesce(top > best["score"], F.lit(False)), own).otherwise(best)

    def step(acc: Column, unit: Column) -> Column:
        name, names, i = unit["name"], acc["names"], acc["i"]
        opens = (unit["op"] == OPENS) & name.isin(*K.BLOCK_ELEMENTS)
        at = F.when(unit["op"] == CLOSES, F.array_position(names, name)).otherwise(F.lit(0)).cast("int")
        linked = F.when(name == "a", unit["op"] == OPENS).otherwise(acc["linked"])
        moved = lambda stack, value: F.when(opens, _pushed(stack, value)).when(at > 0, _rest(stack, at)).otherwise(stack)

        def with_text(scores: Column) -> Column:
            words = F.when(linked, -unit["words"]).otherwise(unit["words"])
            return F.transform(scores, lambda s, k: s + F.when(k < 2, 2 * words).when(k == 2, words).otherwise(F.lit(0)))

        scores = let(moved(acc["scores"], F.lit(0)), lambda s: F.when(unit["words"] > 0, with_text(s)).otherwise(s))
        return F.struct(
            (i + F.lit(1)).alias("i"),
            linked.alias("linked"),
            moved(names, name).alias("names"),
            moved(acc["starts"], i).alias("starts"),
            scores.alias("scores"),
            F.when(at > 0, better(acc["best"], acc["scores"], acc["starts"], at, i)).otherwise(acc["best"]).alias("best"),
        )

    finish = lambda acc: better(acc["best"], acc["scores"], acc["starts"], F.size(acc["scores"]), acc["i"])
    return F.aggregate(F.transform(units, seen), start, step, finish)


def main_content(cleaned_html) -> Column:
    """F2 on HTML already passed through :func:`strip_dropped_elements`; '' when no element has enough words (callers then fall back to F1)."""
    body = F.regexp_replace(_c(cleaned_html), rf"(?is)^.*?{open_tag('body')}", "")

    def text(units: Column) -> Column:
        inside = lambda s: F.array_join(F.slice(units, s["a"] + F.lit(1), s["b"] - s["a"]), "")
        return let(_best_block(units), lambda s: F.when(s["score"] >= 2 * K.MAIN_MIN_WORDS, tags_to_text(inside(s))).otherwise(F.lit("")))

    return let(_units(body), text)
