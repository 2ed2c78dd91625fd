"""Column functions for URLs (inventory U1-U3, P2, P3, J5, D9, T4).

A URL is split with the RFC 3986 appendix-B expression; query strings are
handled as arrays of (key, value) structs with higher-order functions, so the
whole canonicalisation is one projection without Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .common import col as _c
from .common import let


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def url_part(col, idx: int) -> Column:
    """Group ``idx`` of the RFC 3986 split: 1 scheme, 2 authority, 3 path,
    4 query, 5 fragment ('' when absent)."""
    return F.regexp_extract(_c(col), K.URL_RE, idx)


def _escape_bad_percent(col: Column) -> Column:
    return F.regexp_replace(col, K.BAD_PERCENT_RE, "%25")


def form_decode(col) -> Column:
    """Query-component decoding: '+' is a space, %XX escapes decoded, invalid
    escapes kept as written."""
    c = _c(col)
    return F.coalesce(F.try_url_decode(_escape_bad_percent(c)), F.regexp_replace(c, r"\+", " "))


def percent_decode(col) -> Column:
    """Plain percent-decoding: '+' stays '+'."""
    c = _c(col)
    protected = F.regexp_replace(_escape_bad_percent(c), r"\+", "%2B")
    return F.coalesce(F.try_url_decode(protected), c)


def form_encode(col) -> Column:
    """Form encoding with space as '+', '~' kept and '*' escaped."""
    enc = F.url_encode(_c(col))
    return F.replace(F.replace(enc, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(query) -> Column:
    """Non-blank ``key=value`` pairs of a query string, decoded, in order:
    array<struct<k:string, v:string>>."""
    pieces = F.filter(
        F.split(_c(query), "&"),
        lambda p: (F.instr(p, "=") > 0) & (F.length(p) > F.instr(p, "=")),
    )
    return F.transform(
        pieces,
        lambda p: F.struct(
            form_decode(F.substring_index(p, "=", 1)).alias("k"),
            form_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v"),
        ),
    )


def _first_value(pairs: Column, key: str) -> Column:
    return F.get(F.filter(pairs, lambda p: p["k"] == F.lit(key)), 0)["v"]


def unwrap_redirect(col) -> Column:
    """If the authority contains the search-engine marker, the first value
    of the first present key among (uddg, u3, rut, u), percent-decoded a
    second time; the URL itself otherwise."""

    def body(url: Column) -> Column:
        scheme = url_part(url, 1)
        authority = F.when((scheme == "") | scheme.rlike(K.SCHEME_OK_RE), url_part(url, 2)).otherwise(F.lit(""))
        is_wrapped = F.instr(authority, K.REDIRECT_HOST_MARKER) > 0

        def pick(pairs: Column) -> Column:
            target = F.coalesce(*[_first_value(pairs, k) for k in K.REDIRECT_KEYS])
            return let(target, lambda t: F.when(t.isNotNull(), percent_decode(t)).otherwise(url))

        return F.when(is_wrapped, let(query_pairs(url_part(url, 4)), pick)).otherwise(url)

    return let(_c(col), body)


def canonical_from_parts(scheme_raw, netloc, path, query) -> Column:
    """U2 (+P2, J5, T4) from the RFC 3986 parts of an unwrapped URL.

    '' when the scheme is missing, invalid or blocked, or the bracketed host is
    malformed; tracking keys (case-insensitive) and blank values dropped;
    remaining pairs sorted by (key, value) and re-encoded; fragment dropped;
    trailing '/' stripped; empty path becomes '/'; scheme lowercased, host case
    kept.
    """
    scheme_raw, netloc, path, query = map(_c, (scheme_raw, netloc, path, query))
    scheme = F.lower(scheme_raw)
    tracking = _lits(K.TRACKING_PARAMS)
    kept = F.filter(query_pairs(query), lambda p: ~F.array_contains(tracking, F.lower(p["k"])))
    new_query = F.array_join(
        F.transform(
            F.array_sort(kept),
            lambda p: F.concat(form_encode(p["k"]), F.lit("="), form_encode(p["v"])),
        ),
        "&",
    )

    has_params = F.array_contains(_lits(K.USES_PARAMS), scheme) & (F.instr(path, ";") > 0)
    path_main = F.when(has_params, F.regexp_extract(path, K.PATH_PARAMS_RE, 1)).otherwise(path)
    params = F.when(has_params, F.regexp_extract(path, K.PATH_PARAMS_RE, 2)).otherwise(F.lit(""))
    stripped = F.regexp_replace(path_main, "/+$", "")
    full_path = F.concat(
        F.when(stripped == "", F.lit("/")).otherwise(stripped),
        F.when(params != "", F.concat(F.lit(";"), params)).otherwise(F.lit("")),
    )

    def with_path(fp: Column) -> Column:
        return (
            F.when(netloc != "", F.concat(F.lit("//"), netloc, fp))
            .when(fp.startswith("//"), F.concat(F.lit("//"), fp))
            .when(F.array_contains(_lits(K.USES_NETLOC), scheme) & fp.startswith("/"), F.concat(F.lit("//"), fp))
            .otherwise(fp)
        )

    rebuilt = F.concat(
        scheme,
        F.lit(":"),
        let(full_path, with_path),
        let(new_query, lambda nq: F.when(nq != "", F.concat(F.lit("?"), nq)).otherwise(F.lit(""))),
    )
    bad_brackets = (netloc.contains("[") | netloc.contains("]")) & ~netloc.rlike(
        K.BRACKET_HOST_OK_RE
    )
    rejected = (
        (scheme_raw == "")
        | ~scheme_raw.rlike(K.SCHEME_OK_RE)
        | F.array_contains(_lits(K.BLOCKED_SCHEMES), scheme)
        | bad_brackets
    )
    return F.when(rejected, F.lit("")).otherwise(rebuilt)


def canonical_url(col) -> Column:
    """U2 of an X1-normalised URL (each part computed once per row)."""

    def parts(u: Column) -> Column:
        return F.struct(*[url_part(u, i).alias(f"g{i}") for i in range(1, 5)])

    return let(
        unwrap_redirect(col),
        lambda u: let(parts(u), lambda p: canonical_from_parts(p["g1"], p["g2"], p["g3"], p["g4"])),
    )


def with_canonical_url(df, url_col: str, out_col: str = "normalized_url", domain_col: str | None = "domain"):
    """Add the canonical URL (and its domain) of ``url_col`` to ``df``."""
    df = df.withColumn(out_col, canonical_url(url_col))
    if domain_col:
        df = df.withColumn(domain_col, url_domain(out_col))
    return df


def url_domain(col) -> Column:
    """Lowercased authority of a canonical URL (port, userinfo and 'www.'
    kept)."""
    return F.lower(url_part(col, 2))


def host_allowed(domain, blocked_tokens) -> Column:
    """Host non-empty and containing none of the blocked substrings."""
    d = _c(domain)
    cond = d != ""
    for tok in blocked_tokens:
        cond = cond & (F.instr(d, tok) == 0)
    return cond


def excluded_by_site(domain, exclude_hosts) -> Column:
    """``-site:host`` semantics: the domain is a host or one of its
    subdomains."""
    d = _c(domain)
    return F.exists(
        _c(exclude_hosts),
        lambda h: (d == h) | d.endswith(F.concat(F.lit("."), h)),
    )
