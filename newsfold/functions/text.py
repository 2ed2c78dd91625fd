"""Column functions for text: whitespace, cleaning, keys, tokens, versions,
signatures, region and language hints (inventory X1-X11, L1, L2).

Every function takes and returns a ``Column`` built from JVM-side built-ins,
so it stays inside whole-stage codegen (higher-order array functions are
interpreted but still JVM-side).  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .common import col as _c
from .common import let


#: K.WS in Java's spelling: printable ASCII is ruled out by one range before the class's own ranges are tried.
WS_RE = rf"[[^!-~]&&{K.WS.removesuffix('+')}]+"
#: Any boilerplate phrase; each begins with one of the letters looked for first.
BOILERPLATE_RE = f"(?i)(?=[{''.join(sorted({p[0] for p in K.BOILERPLATE_PATTERNS}))}])(?:{'|'.join(K.BOILERPLATE_PATTERNS)})"


def normalize_ws(col) -> Column:
    """Collapse Unicode whitespace runs to one space, trim; null -> ''."""
    return F.trim(F.regexp_replace(F.coalesce(_c(col), F.lit("")), WS_RE, " "))


def clean_text(col, max_chars) -> Column:
    """X1, drop boilerplate phrases (in order, case-insensitive, inside
    words too), X1 again, cut to ``max_chars`` code points, trim."""
    def without_phrases(t: Column) -> Column:
        out = t
        for pat in K.BOILERPLATE_PATTERNS:
            out = F.regexp_replace(out, "(?i)" + pat, " ")
        return F.when(t.rlike(BOILERPLATE_RE), normalize_ws(out)).otherwise(t)

    t = let(normalize_ws(col), without_phrases)
    n = max_chars if isinstance(max_chars, Column) else F.lit(int(max_chars))
    return F.trim(F.substring(t, F.lit(1), n))


def excerpt(col, max_chars: int = K.EXCERPT_CHARS) -> Column:
    """X1; if longer than ``max_chars`` cut there, back up to the last
    space and append '...'."""
    def body(t: Column) -> Column:
        clipped = F.trim(F.regexp_replace(F.substring(t, 1, max_chars), r" [^ ]*\z", ""))
        return F.when(F.length(t) <= max_chars, t).otherwise(F.concat(clipped, F.lit("...")))

    return let(normalize_ws(col), body)


def _words(col, drop_pattern: str) -> Column:
    lowered = F.lower(normalize_ws(col))
    return F.split(F.regexp_replace(lowered, f"{drop_pattern}+", " "), " ")


def title_key(col) -> Column:
    """Lowercase, keep [a-z0-9], CJK ideographs and space; tokens longer
    than two characters; first twelve; joined by a space."""
    toks = F.filter(_words(col, K.TITLE_KEY_DROP), lambda x: F.length(x) > 2)
    return F.array_join(F.slice(toks, 1, K.TITLE_KEY_TOKENS), " ")


def tokens(col) -> Column:
    """Ordered token list: lowercase, keep [a-z0-9 CJK . + -], drop tokens
    of length <= 2 and stopwords.  Duplicates and order are kept."""
    return F.filter(_words(col, K.TOKEN_DROP), lambda x: (F.length(x) > 2) & ~x.isin(*K.STOPWORDS))


def token_set(col) -> Column:
    """Distinct tokens of ``col`` in sorted order (a set as a canonical array)."""
    return F.sort_array(F.array_distinct(tokens(col)))


def page_token_set(title, snippet, content) -> Column:
    """X6 with X11: token set of title + snippet + first 800 content chars."""
    joined = F.concat_ws(
        " ",
        F.coalesce(_c(title), F.lit("")),
        F.coalesce(_c(snippet), F.lit("")),
        F.substring(F.coalesce(_c(content), F.lit("")), 1, K.TOKEN_CONTENT_CHARS),
    )
    return token_set(joined)


def title_token_set(title) -> Column:
    """Token set of the title."""
    return token_set(title)


def version_haystack(title, snippet, content) -> Column:
    return F.lower(
        F.concat_ws(
            " ",
            F.coalesce(_c(title), F.lit("")),
            F.coalesce(_c(snippet), F.lit("")),
            F.substring(
                F.coalesce(_c(content), F.lit("")), 1, K.VERSION_CONTENT_CHARS
            ),
        )
    )


def version_token(col) -> Column:
    """X9 on an already assembled haystack: first ``v?d.d[.d[.d]]`` token with
    Unicode word boundaries; '' when none."""
    return F.regexp_extract(_c(col), K.VERSION_RE, 1)


def page_version(title, snippet, content) -> Column:
    """X9 for a page: title + snippet + first 400 content chars, lowercased."""
    return version_token(version_haystack(title, snippet, content))


def is_pure_version(col) -> Column:
    """The whole token is a version."""
    return _c(col).rlike(K.PURE_VERSION_RE)


def release_signature(title, version) -> Column:
    """First four title tokens outside the skip list, plus '::version'
    when both exist; the bare phrase otherwise."""
    skip = F.array(*[F.lit(w) for w in K.SIGNATURE_SKIP_TOKENS])
    core = F.filter(tokens(title), lambda x: ~F.array_contains(skip, x))
    phrase = F.array_join(F.slice(core, 1, K.SIGNATURE_TOKENS), " ")
    v = _c(version)
    return let(
        phrase,
        lambda ph: F.when((v != "") & (ph != ""), F.concat(ph, F.lit("::"), v)).otherwise(ph),
    )


def overlap_at_least(inter, n_left, n_right, pct: int) -> Column:
    """C7 threshold test in integers: inter / min(n) >= pct/100, and 0 when a
    side is empty (equal to the float test for any realistic size)."""
    m = F.least(n_left, n_right)
    return (m > 0) & (F.lit(100) * inter >= F.lit(pct) * m)


def overlap_ratio(left, right) -> Column:
    """|L & R| / min(|L|, |R|), 0.0 if either side is empty."""
    l, r = _c(left), _c(right)
    m = F.least(F.size(l), F.size(r))
    return F.when(m > 0, F.size(F.array_intersect(l, r)) / m).otherwise(F.lit(0.0))


def region(col) -> Column:
    """L1: search region of a query text (first matching class wins)."""
    c = F.coalesce(_c(col), F.lit(""))
    out = F.lit(K.DEFAULT_REGION)
    for pattern, value in reversed(K.REGION_RULES):
        out = F.when(c.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def language_hint(col) -> Column:
    """L2: zh -> ja -> ko -> ru -> en -> unknown on the X1-normalised text."""
    raw = F.coalesce(_c(col), F.lit(""))

    def body(sample: Column) -> Column:
        out = F.lit(K.DEFAULT_LANGUAGE)
        for pattern, value in reversed(K.LANGUAGE_RULES):
            out = F.when(sample.rlike(pattern), F.lit(value)).otherwise(out)
        return out

    return F.when(raw == "", F.lit(K.DEFAULT_LANGUAGE)).otherwise(let(normalize_ws(raw), body))
