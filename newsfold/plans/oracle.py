"""DuckDB oracle: the same semantics written independently as SQL.

Used only for checking (``oracle_sql()`` in ``__spark_entry__``).  Where the
Spark jobs use prefix filtering, label propagation, ``max_by`` and higher-order
functions, the oracle uses brute-force pairs, a recursive CTE, window
``row_number`` and ``unnest``.  Regular expressions are the shared constants,
valid in both Java regex and RE2.
"""

from __future__ import annotations

from html.entities import html5

from .. import constants as K
from ..sources.tasks import TaskConfig

NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]::VARCHAR[]"


# ---------------------------------------------------------------- text


def ws(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), {lit(K.WS)}, ' ', 'g'))"


def clean_text(x: str, n: str) -> str:
    t = ws(x)
    for pat in K.BOILERPLATE_PATTERNS:
        t = f"regexp_replace({t}, {lit('(?i)' + pat)}, ' ', 'g')"
    return f"trim(substring({ws(t)}, 1, {n}))"


def excerpt(x: str, n: int = K.EXCERPT_CHARS) -> str:
    t = ws(x)
    clipped = f"trim(regexp_replace(substring({t}, 1, {n}), {lit(' [^ ]*\\z')}, ''))"
    return f"(CASE WHEN length({t}) <= {n} THEN {t} ELSE {clipped} || '...' END)"


def words(x: str, drop: str) -> str:
    return f"string_split(regexp_replace(lower({ws(x)}), {lit(drop)}, ' ', 'g'), ' ')"


def title_key(x: str) -> str:
    toks = f"list_filter({words(x, K.TITLE_KEY_DROP)}, lambda w: length(w) > 2)"
    return f"array_to_string(list_slice({toks}, 1, {K.TITLE_KEY_TOKENS}), ' ')"


def tokens(x: str) -> str:
    return (
        f"list_filter({words(x, K.TOKEN_DROP)}, lambda w: length(w) > 2 "
        f"AND NOT list_contains({str_list(K.STOPWORDS)}, w))"
    )


def token_set(x: str) -> str:
    return f"list_sort(list_distinct({tokens(x)}))"


def page_text3(title: str, snippet: str, content: str, n: int) -> str:
    return f"concat_ws(' ', coalesce({title}, ''), coalesce({snippet}, ''), substring(coalesce({content}, ''), 1, {n}))"


def version_of(haystack: str) -> str:
    return f"regexp_extract({haystack}, {lit(K.VERSION_RE)}, 1)"


def page_version(title: str, snippet: str, content: str) -> str:
    return version_of(f"lower({page_text3(title, snippet, content, K.VERSION_CONTENT_CHARS)})")


def signature(title: str, version: str) -> str:
    core = f"list_filter({tokens(title)}, lambda w: NOT list_contains({str_list(K.SIGNATURE_SKIP_TOKENS)}, w))"
    phrase = f"array_to_string(list_slice({core}, 1, {K.SIGNATURE_TOKENS}), ' ')"
    return f"(CASE WHEN {version} <> '' AND {phrase} <> '' THEN {phrase} || '::' || {version} ELSE {phrase} END)"


def region(x: str) -> str:
    parts = " ".join(f"WHEN regexp_matches(coalesce({x}, ''), {lit(p)}) THEN {lit(v)}" for p, v in K.REGION_RULES)
    return f"(CASE {parts} ELSE {lit(K.DEFAULT_REGION)} END)"


def language(x: str) -> str:
    s = ws(x)
    parts = " ".join(f"WHEN regexp_matches({s}, {lit(p)}) THEN {lit(v)}" for p, v in K.LANGUAGE_RULES)
    return f"(CASE WHEN coalesce({x}, '') = '' THEN {lit(K.DEFAULT_LANGUAGE)} {parts} ELSE {lit(K.DEFAULT_LANGUAGE)} END)"


def overlap_ok(inter: str, n1: str, n2: str, pct: int) -> str:
    return f"(least({n1}, {n2}) > 0 AND 100 * {inter} >= {pct} * least({n1}, {n2}))"


def overlap_ratio(a: str, b: str) -> str:
    m = f"least(len({a}), len({b}))"
    return f"(CASE WHEN {m} > 0 THEN len(list_intersect({a}, {b})) / {m} ELSE 0.0 END)::DOUBLE"


def domain_score(d: str) -> str:
    terms = []
    for needles, pts in K.DOMAIN_RULES:
        cond = " OR ".join(f"strpos({d}, {lit(n)}) > 0" for n in needles)
        terms.append(f"(CASE WHEN {cond} THEN {pts} ELSE 0 END)")
    return "(" + " + ".join(terms) + ")"


def official_bonus(d: str) -> str:
    cond = " OR ".join(f"strpos({d}, {lit(n)}) > 0" for n in K.OFFICIAL_HOSTS)
    return f"(CASE WHEN {cond} THEN {K.OFFICIAL_BONUS} ELSE 0 END)"


# ---------------------------------------------------------------- html


#: The tag pattern of functions/html.py in RE2 spelling.
TAG_RE = """<(?:[^>"']|"[^"]*"|'[^']*')*>|<[^>]*>"""
#: Names that the tables hold; tests compare the whole name table with the standard library.
ENTITY_NAMES = ("amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "middot", "ndash", "mdash", "hellip", "eacute", "uuml", "rsquo")


def decode_entities(x: str) -> str:
    names = "map([" + ", ".join(lit(n) for n in ENTITY_NAMES) + "], [" + ", ".join(lit(html5[n + ";"]) for n in ENTITY_NAMES) + "])"
    ref = f"regexp_extract('&' || p, {lit(K.ENTITY_RE)}, 1)"

    def point(n: str) -> str:
        return f"(CASE WHEN {n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111 THEN chr({n}) ELSE chr(65533) END)"

    text = (
        f"CASE WHEN {ref} = '' THEN NULL WHEN lower({ref}[1:2]) = '#x' THEN {point(f'try_cast(concat(chr(48), chr(120), {ref}[3:]) AS INT)')} "
        f"WHEN {ref}[1] = '#' THEN {point(f'try_cast({ref}[2:] AS INT)')} ELSE {names}[{ref}] END"
    )
    rest = f"list_transform(string_split({x}, '&')[2:], lambda p: coalesce(({text}) || substring(p, length({ref}) + 2), '&' || p))"
    return f"(CASE WHEN contains({x}, '&') THEN string_split({x}, '&')[1] || array_to_string({rest}, '') ELSE {x} END)"


def open_tag(name: str) -> str:
    return rf"<{name}(?:[\s/][^>]*)?>"


RAW_RE = r"(?is)<!--.*?(?:-->|\z)" + "".join(rf"|{open_tag(t)}.*?(?:</{t}\s*>|\z)" for t in ("script", "style"))


def units(h: str) -> str:
    """A page as a list: the text before the first tag, then each tag with the text after it."""
    tags, texts = f"regexp_extract_all({h}, {lit(TAG_RE)})", f"regexp_split_to_array({h}, {lit(TAG_RE)})"
    return f"list_transform({texts}, lambda t, k: CASE WHEN k = 1 THEN t ELSE {tags}[k - 1] || t END)"


def tag_name(u: str) -> str:
    return f"lower(regexp_extract({u}, {lit('^</?([A-Za-z][^ ' + chr(92) + 't' + chr(92) + 'n' + chr(92) + 'r' + chr(92) + 'f/>]*)')}, 1))"


def tag_op(u: str, name: str) -> str:
    """2 closes, 1 opens, 0 neither."""
    return (
        f"(CASE WHEN {name} = '' THEN 0 WHEN starts_with({u}, '</') THEN 2 WHEN list_contains({str_list(K.VOID_ELEMENTS)}, {name}) "
        f"OR regexp_matches({u}, '^<[^>]*/>') THEN 0 ELSE 1 END)"
    )


def strip_ctes(src: str, out: str, keep: str, html: str = "html") -> list[str]:
    """``out``: the columns ``keep`` of ``src`` and clean, its HTML without comments and dropped elements: a walk over the tags with a
    stack of the open elements (names joined, newest first)."""
    at = "strpos(a.path, '/' || u.name || '/')"
    popped = f"substring(a.path, {at} + length(u.name) + 1)"
    gone = f"(u.op = 2 AND a.off >= 0 AND {at} > 0 AND length({popped}) <= a.off)"
    begun = f"(u.op = 1 AND a.off < 0 AND list_contains({str_list(K.DROPPED_ELEMENTS)}, u.name))"
    return [
        f"{out}_u AS (SELECT {keep}, {units('raw')} AS us FROM (SELECT {keep}, regexp_replace(coalesce({html}, ''), {lit(RAW_RE)}, ' ', 'g') AS raw FROM {src}))",
        f"{out}_t AS (SELECT {keep}, us, list_transform(us, lambda u: {{'name': {tag_name('u')}, 'op': {tag_op('u', tag_name('u'))}, 'path': '', 'off': -1, 'text': u}}) AS ts FROM {out}_u)",
        # text gathers what stays; off is the length of the path below the outermost dropped element
        f"{out} AS (SELECT {keep}, (list_reduce(ts, lambda a, u: {{'name': '', 'op': 0, "
        f"'path': CASE WHEN u.op = 1 THEN '/' || u.name || a.path WHEN u.op = 2 AND {at} > 0 THEN {popped} ELSE a.path END, "
        f"'off': CASE WHEN {begun} THEN length(a.path) WHEN {gone} THEN -1 ELSE a.off END, "
        f"'text': CASE WHEN {begun} OR (a.off >= 0 AND NOT {gone}) THEN a.text ELSE a.text || u.text END}}, "
        f"{{'name': '', 'op': 0, 'path': '/', 'off': -1, 'text': ''}})).text AS clean FROM {out}_t)",
    ]


def tags_to_text(x: str) -> str:
    return ws(decode_entities(f"regexp_replace({x}, {lit(TAG_RE)}, ' ', 'g')"))


def html_title(h: str) -> str:
    pattern = f"(?is){open_tag('title')}(.*?)</title\\s*>"
    return tags_to_text(f"regexp_extract(coalesce({h}, ''), {lit(pattern)}, 1)")


def main_ctes(src: str, out: str, clean: str = "clean") -> list[str]:
    """``out``: ``src`` and main_text: the element that its texts give the most words, by a walk over the tags.  The stack holds
    (name, first unit, score), newest first; closed elements gather in done."""
    body = f"regexp_replace({clean}, {lit('(?is)^.*?' + open_tag('body'))}, '')"
    words = f"len(regexp_extract_all(regexp_replace(u, {lit('^(?:' + TAG_RE + ')')}, ''), {lit('[^ ' + chr(92) + 't' + chr(92) + 'n' + chr(92) + 'x0B' + chr(92) + 'f' + chr(92) + 'r]+')}))::INT"
    at = "coalesce(list_position(list_transform(a.stack, lambda e: e.name), u.name), 0)"
    pop = f"(u.op = 2 AND {at} > 0)"
    push = f"(u.op = 1 AND list_contains({str_list(K.BLOCK_ELEMENTS)}, u.name))"
    link = "(CASE WHEN u.name = 'a' THEN u.op = 1 ELSE a.linked END)"
    moved = (
        f"(CASE WHEN {push} THEN list_prepend({{'name': u.name, 'first': a.i, 'last': 0, 'score': 0}}, a.stack) "
        f"WHEN {pop} THEN a.stack[{at} + 1:] ELSE a.stack END)"
    )
    given = f"(CASE WHEN {link} THEN -u.words ELSE u.words END)"
    scored = f"list_transform({moved}, lambda e, k: {{'name': e.name, 'first': e.first, 'last': e.last, 'score': (e.score + (CASE WHEN k <= 2 THEN 2 WHEN k = 3 THEN 1 ELSE 0 END) * {given})::INT}})"
    closed = f"(CASE WHEN {pop} THEN list_concat(a.done, list_transform(a.stack[:{at}], lambda e: {{'name': e.name, 'first': e.first, 'last': a.i, 'score': e.score}})) ELSE a.done END)"
    none = "[]::STRUCT(name VARCHAR, first INT, last INT, score INT)[]"
    root = "[{'name': '', 'first': 0, 'last': 0, 'score': 0}]::STRUCT(name VARCHAR, first INT, last INT, score INT)[]"
    blank = f"'i': 0, 'linked': FALSE, 'stack': {none}, 'done': {none}"
    inside = "array_to_string(mu[best.first + 1:best.last], '')"
    return [
        f"{out}_u AS (SELECT *, {units(body)} AS mu FROM {src})",
        f"{out}_t AS (SELECT *, list_transform(mu, lambda u: {{'name': {tag_name('u')}, 'op': {tag_op('u', tag_name('u'))}, 'words': {words}, {blank}}}) AS mt FROM {out}_u)",
        f"{out}_f AS (SELECT * EXCLUDE (mt), list_reduce(mt, lambda a, u: {{'name': '', 'op': 0, 'words': 0, 'i': (a.i + 1)::INT, 'linked': {link}, "
        f"'stack': {scored}, 'done': {closed}}}, {{'name': '', 'op': 0, 'words': 0, 'i': 0, 'linked': FALSE, 'stack': {root}, 'done': {none}}}) AS f FROM {out}_t)",
        f"{out}_b AS (SELECT * EXCLUDE (f), list_concat(f.done, list_transform(f.stack, lambda e: {{'name': e.name, 'first': e.first, 'last': f.i, 'score': e.score}})) AS es FROM {out}_f)",
        f"{out}_m AS (SELECT * EXCLUDE (es), es[list_position(list_transform(es, lambda e: e.score), list_max(list_transform(es, lambda e: e.score)))] AS best FROM {out}_b)",
        f"{out} AS (SELECT * EXCLUDE (mu, best), CASE WHEN best.score >= {2 * K.MAIN_MIN_WORDS} THEN {tags_to_text(inside)} ELSE '' END AS main_text FROM {out}_m)",
    ]


# ---------------------------------------------------------------- urls


def form_decode(x: str) -> str:
    r = f"replace({x}, '+', ' ')"
    return f"coalesce(try(url_decode({r})), {r})"


def percent_decode(x: str) -> str:
    return f"coalesce(try(url_decode({x})), {x})"


def form_encode(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def url_part(x: str, i: int) -> str:
    return f"regexp_extract({x}, {lit(K.URL_RE)}, {i})"


def query_pairs(q: str) -> str:
    pieces = f"list_filter(string_split({q}, '&'), lambda p: strpos(p, '=') > 0 AND length(p) > strpos(p, '='))"
    key = form_decode("split_part(p, '=', 1)")
    value = form_decode("substr(p, strpos(p, '=') + 1)")
    return f"list_transform({pieces}, lambda p: {{'k': {key}, 'v': {value}}})"


def url_ctes(src: str, url_expr: str, keep: str, name: str) -> list[str]:
    """CTEs computing ``normalized_url`` and ``domain`` of ``url_expr`` over
    relation ``src``; ``keep`` are carried columns (comma-separated)."""
    k = f"{keep}, " if keep else ""
    c1 = (
        f"{name}_u1 AS (SELECT {k}{url_expr} AS u0, {url_part('(' + url_expr + ')', 1)} AS s0, "
        f"{url_part('(' + url_expr + ')', 2)} AS n0, {url_part('(' + url_expr + ')', 4)} AS q0 FROM {src})"
    )
    pairs = query_pairs("q0")
    firsts = ", ".join(f"list_filter({pairs}, lambda x: x.k = {lit(key)})[1].v" for key in K.REDIRECT_KEYS)
    c2 = (
        f"{name}_u2 AS (SELECT *, coalesce({firsts}) AS tgt, "
        f"CASE WHEN s0 = '' OR regexp_matches(s0, {lit(K.SCHEME_OK_RE)}) THEN n0 ELSE '' END AS auth0 FROM {name}_u1)"
    )
    c3 = (
        f"{name}_u3 AS (SELECT *, CASE WHEN strpos(auth0, {lit(K.REDIRECT_HOST_MARKER)}) > 0 AND tgt IS NOT NULL "
        f"THEN {percent_decode('tgt')} ELSE u0 END AS uw FROM {name}_u2)"
    )
    c4 = (
        f"{name}_u4 AS (SELECT *, {url_part('uw', 1)} AS s, {url_part('uw', 2)} AS n, "
        f"{url_part('uw', 3)} AS p, {url_part('uw', 4)} AS q FROM {name}_u3)"
    )
    kept = f"list_filter({query_pairs('q')}, lambda x: NOT list_contains({str_list(K.TRACKING_PARAMS)}, lower(x.k)))"
    newq = f"array_to_string(list_transform(list_sort({kept}), lambda x: {form_encode('x.k')} || '=' || {form_encode('x.v')}), '&')"
    has_params = f"(list_contains({str_list(K.USES_PARAMS)}, lower(s)) AND strpos(p, ';') > 0)"
    c5 = (
        f"{name}_u5 AS (SELECT *, lower(s) AS sch, {newq} AS newq, "
        f"CASE WHEN {has_params} THEN regexp_extract(p, {lit(K.PATH_PARAMS_RE)}, 1) ELSE p END AS pmain, "
        f"CASE WHEN {has_params} THEN regexp_extract(p, {lit(K.PATH_PARAMS_RE)}, 2) ELSE '' END AS params "
        f"FROM {name}_u4)"
    )
    c6 = (
        f"{name}_u6 AS (SELECT *, (CASE WHEN regexp_replace(pmain, '/+$', '') = '' THEN '/' "
        f"ELSE regexp_replace(pmain, '/+$', '') END) || (CASE WHEN params <> '' THEN ';' || params ELSE '' END) AS fp "
        f"FROM {name}_u5)"
    )
    body = (
        "(CASE WHEN n <> '' THEN '//' || n || fp WHEN starts_with(fp, '//') THEN '//' || fp "
        f"WHEN list_contains({str_list(K.USES_NETLOC)}, sch) AND starts_with(fp, '/') THEN '//' || fp ELSE fp END)"
    )
    rejected = (
        f"(s = '' OR NOT regexp_matches(s, {lit(K.SCHEME_OK_RE)}) OR list_contains({str_list(K.BLOCKED_SCHEMES)}, sch) "
        f"OR ((strpos(n, '[') > 0 OR strpos(n, ']') > 0) AND NOT regexp_matches(n, {lit(K.BRACKET_HOST_OK_RE)})))"
    )
    c7 = (
        f"{name} AS (SELECT {k}uw AS unwrapped, CASE WHEN {rejected} THEN '' ELSE sch || ':' || {body} || "
        f"(CASE WHEN newq <> '' THEN '?' || newq ELSE '' END) END AS normalized_url, "
        f"CASE WHEN {rejected} THEN '' ELSE lower(n) END AS domain FROM {name}_u6)"
    )
    return [c1, c2, c3, c4, c5, c6, c7]


def host_allowed(d: str, blocked) -> str:
    cond = f"{d} <> ''"
    for t in blocked:
        cond += f" AND strpos({d}, {lit(t)}) = 0"
    return f"({cond})"


def sql_fmt(template: str, **exprs) -> str:
    """A format line from ``constants`` as a SQL concatenation."""
    import re

    parts = []
    for lit_part, name in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if lit_part:
            parts.append(lit(lit_part))
        if name:
            parts.append(f"CAST({exprs[name]} AS VARCHAR)")
    return "(" + " || ".join(parts) + ")"


def sql_lines(*exprs: str) -> str:
    return "(" + f" || {NL} || ".join(exprs) + ")"


def with_(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def with_recursive(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


# ---------------------------------------------------------------- page tables


def page_base_ctes(with_main: bool = True, src: str = "pages") -> list[str]:
    """page_base(page_id, url, page_title, body_text[, main_text, readable_text],
    normalized_url, domain)"""
    ctes = [f"pb_in AS (SELECT page_id, " + ws("url") + " AS url, " + html_title("html") + f" AS page_title, html FROM {src})"]
    ctes += strip_ctes("pb_in", "pb_src", "page_id, url, page_title")
    ctes += url_ctes("pb_src", "url", "page_id, url, page_title, clean", "pb_url")
    ctes.append(f"pb_body AS (SELECT page_id, url, page_title, normalized_url, domain, clean, {tags_to_text('clean')} AS body_text FROM pb_url)")
    if not with_main:
        return ctes + ["page_base AS (SELECT * EXCLUDE (clean) FROM pb_body)"]
    readable = "CASE WHEN main_text <> '' THEN main_text ELSE body_text END AS readable_text"
    return ctes + main_ctes("pb_body", "pb_txt") + [f"page_base AS (SELECT * EXCLUDE (clean), {readable} FROM pb_txt)"]


def resolved_expr(found: str, page_title: str, readable: str, hit_title: str, snippet: str, max_chars: str, status: str = "fallback:HTTPError") -> dict:
    text = f"(CASE WHEN coalesce({readable}, '') <> '' THEN {readable} ELSE {snippet} END)"
    source = f"(CASE WHEN {found} THEN {text} ELSE {snippet} END)"
    cleaned = clean_text(source, max_chars)
    title = f"(CASE WHEN {found} AND coalesce({page_title}, '') <> '' THEN {page_title} ELSE {hit_title} END)"
    return {"title": title, "cleaned": cleaned}


def pages_resolved_ctes(max_chars: int = K.DEFAULT_MAX_CONTENT_CHARS, run_id: str = K.DEFAULT_RUN_ID, run_ts: str = K.DEFAULT_RUN_TS) -> list[str]:
    """resolved(run_id, task_name, arrival_seq, url, normalized_url, title,
    snippet, domain, content, content_chars, fetch_status, fetched_at,
    domain_score): every page as a hit of task 'corpus'."""
    ctes = page_base_ctes(True)
    ctes.append(
        "pr0 AS (SELECT page_id, normalized_url, domain, page_title, readable_text, "
        + excerpt("body_text") + " AS snippet FROM page_base WHERE normalized_url <> '' AND page_title <> '')"
    )
    e = resolved_expr("TRUE", "page_title", "readable_text", "page_title", "snippet", str(max_chars))
    ctes.append(f"pr1 AS (SELECT *, {e['title']} AS title, {e['cleaned']} AS cleaned FROM pr0)")
    ctes.append(
        f"resolved AS (SELECT {lit(run_id)} AS run_id, 'corpus' AS task_name, page_id AS arrival_seq, "
        "normalized_url AS url, normalized_url, title, snippet, domain, "
        "CASE WHEN cleaned = '' THEN snippet ELSE cleaned END AS content, "
        "length(CASE WHEN cleaned = '' THEN snippet ELSE cleaned END) AS content_chars, "
        f"CASE WHEN cleaned <> '' THEN {lit(K.STATUS_OK)} ELSE {lit(K.STATUS_EMPTY)} END AS fetch_status, "
        f"{lit(run_ts.replace(' ', 'T'))} AS fetched_at, {domain_score('domain')} AS domain_score FROM pr1)"
    )
    return ctes


def dedup_ctes(src: str = "resolved") -> list[str]:
    """d2 (url winners with first_seen) and d3 (title winners, seq)."""
    return [
        f"d2r AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_name, normalized_url "
        f"ORDER BY domain_score DESC, content_chars DESC, arrival_seq ASC) AS rn, "
        f"min(arrival_seq) OVER (PARTITION BY run_id, task_name, normalized_url) AS first_seen FROM {src})",
        "d2 AS (SELECT * EXCLUDE (rn) FROM d2r WHERE rn = 1)",
        f"d3k AS (SELECT *, {title_key('title')} AS title_key FROM d2)",
        "d3r AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_name, title_key "
        "ORDER BY domain_score DESC, content_chars DESC, first_seen ASC) AS rn FROM d3k WHERE title_key <> '')",
        "d3 AS (SELECT * EXCLUDE (rn), first_seen AS seq FROM d3r WHERE rn = 1)",
    ]


def feature_ctes(src: str = "d3") -> list[str]:
    return [
        f"fe0 AS (SELECT *, {token_set(page_text3('title', 'snippet', 'content', K.TOKEN_CONTENT_CHARS))} AS tokens, "
        f"{token_set('title')} AS title_tokens, {page_version('title', 'snippet', 'content')} AS version, "
        f"{official_bonus('domain')} AS official_bonus FROM {src})",
        f"feat AS (SELECT *, {signature('title', 'version')} AS signature FROM fe0)",
    ]


def pair_rules() -> tuple[str, str, str]:
    """M2, M3 and M4 between the rows a and b."""
    m2 = overlap_ok("len(list_intersect(a.tokens, b.tokens))", "len(a.tokens)", "len(b.tokens)", K.TOKEN_OVERLAP_PCT)
    tinter = "len(list_intersect(a.title_tokens, b.title_tokens))"
    m3 = (
        "(a.version <> '' AND a.version = b.version AND "
        + overlap_ok(tinter, "len(a.title_tokens)", "len(b.title_tokens)", K.VERSION_TITLE_OVERLAP_PCT)
        + f" AND len(list_filter(list_intersect(a.title_tokens, b.title_tokens), lambda t: NOT regexp_matches(t, {lit(K.PURE_VERSION_RE)}))) > 0)"
    )
    m4 = (
        overlap_ok(tinter, "len(a.title_tokens)", "len(b.title_tokens)", K.TITLE_OVERLAP_PCT)
        + " AND "
        + overlap_ok("len(list_intersect(a.tokens, b.tokens))", "len(a.tokens)", "len(b.tokens)", K.TITLE_TOKEN_OVERLAP_PCT)
    )
    return m2, m3, m4


def edge_ctes() -> list[str]:
    """Brute-force edges between feature classes (oracle of the prefix join)."""
    m2, m3, m4 = pair_rules()
    return [
        "cls_m AS (SELECT run_id, task_name, seq, min(seq) OVER (PARTITION BY run_id, task_name, tokens, title_tokens, version, signature) AS class_seq, "
        "tokens, title_tokens, version, signature FROM feat WHERE len(tokens) > 0)",
        "cls AS (SELECT * FROM cls_m WHERE seq = class_seq)",
        "e_copy AS (SELECT run_id, task_name, class_seq AS a, seq AS b, 'copy' AS rule FROM cls_m WHERE seq <> class_seq)",
        "e_m1 AS (SELECT run_id, task_name, min(class_seq) OVER (PARTITION BY run_id, task_name, signature) AS a, class_seq AS b, 'm1' AS rule "
        "FROM cls WHERE signature <> '')",
        "e_pairs AS (SELECT a.run_id, a.task_name, a.class_seq AS a, b.class_seq AS b, "
        f"{m2} AS m2, {m3} AS m3, {m4} AS m4 "
        "FROM cls a JOIN cls b ON a.run_id = b.run_id AND a.task_name = b.task_name AND a.class_seq < b.class_seq)",
        "e_all AS (SELECT run_id, task_name, a, b, rule FROM e_copy UNION ALL SELECT run_id, task_name, a, b, rule FROM e_m1 WHERE a <> b "
        "UNION ALL SELECT run_id, task_name, a, b, 'm2' FROM e_pairs WHERE m2 "
        "UNION ALL SELECT run_id, task_name, a, b, 'm3' FROM e_pairs WHERE m3 "
        "UNION ALL SELECT run_id, task_name, a, b, 'm4' FROM e_pairs WHERE m4)",
        "edges AS (SELECT run_id, task_name, a, b, array_to_string(list_sort(list_distinct(list(rule))), ',') AS rules "
        "FROM e_all GROUP BY run_id, task_name, a, b)",
    ]


def component_ctes() -> list[str]:
    """labels(run_id, task_name, seq, label) by a recursive walk."""
    return [
        "sym AS (SELECT run_id, task_name, a AS src, b AS dst FROM edges UNION SELECT run_id, task_name, b, a FROM edges)",
        "walk(run_id, task_name, seq, label) AS (SELECT run_id, task_name, seq, seq FROM feat "
        "UNION SELECT w.run_id, w.task_name, s.dst, w.label FROM walk w JOIN sym s "
        "ON w.run_id = s.run_id AND w.task_name = s.task_name AND w.seq = s.src)",
        "labels AS (SELECT run_id, task_name, seq, min(label) AS label FROM walk GROUP BY run_id, task_name, seq)",
    ]


def leader_ctes(out: str = "labels") -> list[str]:
    """``out``(run_id, task_name, seq, label): a recursive walk over the pages in
    their order that carries the founders so far."""
    return [
        "pg AS (SELECT f.run_id, f.task_name, f.seq, f.signature, coalesce(c.class_seq, f.seq) AS class_seq, "
        "row_number() OVER (ORDER BY f.run_id, f.task_name, f.seq) AS n FROM feat f LEFT JOIN cls_m c USING (run_id, task_name, seq))",
        "joined AS (SELECT run_id, task_name, a, b FROM e_pairs WHERE m2 OR m3 OR m4)",
        "near AS (SELECT x.n, y.n AS other FROM pg x JOIN pg y ON x.run_id = y.run_id AND x.task_name = y.task_name AND y.n < x.n "
        "LEFT JOIN joined j ON j.run_id = x.run_id AND j.task_name = x.task_name "
        "AND j.a = least(x.class_seq, y.class_seq) AND j.b = greatest(x.class_seq, y.class_seq) "
        "WHERE x.class_seq = y.class_seq OR (x.signature <> '' AND x.signature = y.signature) OR j.a IS NOT NULL)",
        "nb AS (SELECT pg.n, coalesce(list(near.other) FILTER (WHERE near.other IS NOT NULL), []) AS before FROM pg LEFT JOIN near USING (n) GROUP BY pg.n)",
        "led(n, founders) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL "
        "SELECT nb.n, CASE WHEN len(list_intersect(led.founders, nb.before)) = 0 THEN list_append(led.founders, nb.n) ELSE led.founders END "
        "FROM led JOIN nb ON nb.n = led.n + 1)",
        "allf AS (SELECT arg_max(founders, n) AS founders FROM led)",
        f"{out} AS (SELECT pg.run_id, pg.task_name, pg.seq, coalesce(f.seq, pg.seq) AS label FROM pg JOIN nb USING (n) CROSS JOIN allf "
        "LEFT JOIN pg f ON f.n = list_min(list_intersect(allf.founders, nb.before)))",
    ]


#: Rounds of refinement in the SQL; more change nothing on the test tables (compared by the oracle check).
REFINE_ROUNDS = 3


def refine_ctes(rounds: int = REFINE_ROUNDS) -> list[str]:
    """labels after refinement of ``labels_0``: lone pages against the earlier
    clusters of several pages as they are in each round."""
    m2, m3, m4 = pair_rules()
    key = "run_id, task_name, label"
    out = []
    for k in range(rounds):
        out += [
            f"rf{k} AS (SELECT f.*, l.label, count(*) OVER w AS size, row_number() OVER (PARTITION BY f.run_id, f.task_name, l.label "
            "ORDER BY f.official_bonus DESC, f.domain_score DESC, f.content_chars DESC, f.seq) AS place "
            f"FROM feat f JOIN labels_{k} l USING (run_id, task_name, seq) WINDOW w AS (PARTITION BY f.run_id, f.task_name, l.label))",
            f"ru{k} AS (SELECT {key}, list_distinct(flatten(list(tokens))) AS tokens, "
            f"coalesce(arg_min(signature, seq) FILTER (WHERE signature <> ''), '') AS signature FROM rf{k} WHERE size > 1 GROUP BY ALL)",
            f"rc{k} AS (SELECT {key}, u.tokens, u.signature, r.title_tokens, r.version FROM rf{k} r JOIN ru{k} u USING ({key}) WHERE r.place = 1)",
            f"rm{k} AS (SELECT a.run_id, a.task_name, a.seq, min(b.label) AS dest FROM rf{k} a JOIN rc{k} b "
            "ON a.run_id = b.run_id AND a.task_name = b.task_name AND b.label < a.seq WHERE a.size = 1 "
            f"AND ((a.signature <> '' AND a.signature = b.signature) OR ({m2}) OR ({m3}) OR ({m4})) GROUP BY ALL)",
            f"labels_{k + 1} AS (SELECT l.run_id, l.task_name, l.seq, coalesce(m.dest, l.label) AS label FROM labels_{k} l "
            f"LEFT JOIN rm{k} m USING (run_id, task_name, seq))",
        ]
    return out + [f"labels AS (SELECT * FROM labels_{rounds})"]


def arrival_ctes() -> list[str]:
    """labels(run_id, task_name, seq, label): a keyed walk over the pages in their order.  Its rows are the clusters as they are;
    each step rewrites the one that the next page joins or founds."""
    m2, m3, m4 = pair_rules()
    return [
        "ap AS (SELECT *, row_number() OVER (ORDER BY run_id, task_name, seq) AS n FROM feat)",
        "grown(run_id, task_name, label, n, members, tokens, signature, title_tokens, version, score) USING KEY (run_id, task_name, label) AS ("
        "SELECT run_id, task_name, seq, n, [seq], tokens, signature, title_tokens, version, "
        "{'o': official_bonus, 'd': domain_score, 'c': content_chars} FROM ap WHERE n = 1 "
        "UNION SELECT run_id, task_name, coalesce(label, seq), n, coalesce(list_append(members, seq), [seq]), "
        "coalesce(list_distinct(list_concat(b_tokens, tokens)), tokens), "
        "CASE WHEN coalesce(b_signature, '') <> '' THEN b_signature ELSE signature END, "
        "CASE WHEN b_score >= score THEN b_title_tokens ELSE title_tokens END, "
        "CASE WHEN b_score >= score THEN b_version ELSE version END, "
        "CASE WHEN b_score >= score THEN b_score ELSE score END FROM ("
        "SELECT a.*, {'o': a.official_bonus, 'd': a.domain_score, 'c': a.content_chars} AS score, b.label, b.members, b.tokens AS b_tokens, "
        "b.signature AS b_signature, b.title_tokens AS b_title_tokens, b.version AS b_version, b.score AS b_score, "
        "row_number() OVER (ORDER BY b.label NULLS LAST) AS choice "
        "FROM (SELECT ap.* FROM grown w JOIN ap ON ap.n = w.n + 1) a "
        "LEFT JOIN recurring.grown b ON a.run_id = b.run_id AND a.task_name = b.task_name "
        f"AND ((a.signature <> '' AND a.signature = b.signature) OR ({m2}) OR ({m3}) OR ({m4}))) WHERE choice = 1)",
        "labels AS (SELECT run_id, task_name, unnest(members) AS seq, label FROM grown)",
    ]


def cluster_ctes(cap_expr: str) -> list[str]:
    """members, summary (C8/D4/D7/D8), ranked (T2/T3/W2) and srcs.
    ``cap_expr`` gives final_event_cap for a row of summary (column or literal)."""
    return [
        "members AS (SELECT f.*, l.label FROM feat f JOIN labels l USING (run_id, task_name, seq))",
        "rep_r AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_name, label "
        "ORDER BY official_bonus DESC, domain_score DESC, content_chars DESC, seq ASC) AS rn FROM members)",
        "sig_r AS (SELECT run_id, task_name, label, signature, row_number() OVER (PARTITION BY run_id, task_name, label ORDER BY seq) AS rn "
        "FROM members WHERE signature <> '')",
        "csum AS (SELECT run_id, task_name, label, min(seq) AS first_seen, count(*) AS source_count FROM members GROUP BY ALL)",
        "summary AS (SELECT c.*, r.seq AS rep_seq, r.title AS rep_title, r.url AS rep_url, r.domain AS rep_domain, "
        "r.fetch_status AS rep_status, r.content_chars AS rep_chars, r.content AS rep_content, r.domain_score AS rep_score, "
        "coalesce(s.signature, '') AS release_signature FROM csum c "
        "JOIN rep_r r ON r.run_id = c.run_id AND r.task_name = c.task_name AND r.label = c.label AND r.rn = 1 "
        "LEFT JOIN sig_r s ON s.run_id = c.run_id AND s.task_name = c.task_name AND s.label = c.label AND s.rn = 1)",
        "ordered AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_name ORDER BY rep_score DESC, rep_chars DESC, first_seen ASC) AS cluster_id "
        "FROM summary)",
        f"ranked AS (SELECT * FROM ordered WHERE cluster_id <= {cap_expr})",
        "srcs AS (SELECT m.run_id, m.task_name, r.cluster_id, m.label, r.rep_seq, m.seq, m.title, m.url, m.domain "
        "FROM members m JOIN ranked r USING (run_id, task_name, label))",
    ]


# ---------------------------------------------------------------- config


def queries_values(cfg: TaskConfig) -> str:
    """queries(task_name, query_idx, query_text, exclude_hosts, primary_fails,
    top_k, final_event_cap, max_content_chars) and phrases(task_name,
    query_idx, alt_idx, clause_idx, n_clauses, phrase)."""
    qrows, prows = [], []
    for t in cfg.tasks:
        for i, q in enumerate(t.queries):
            qrows.append(
                f"({lit(t.name)}, {i}, {lit(q.text)}, {str_list([h.lower() for h in q.exclude_hosts])}, "
                f"{'TRUE' if q.primary_fails else 'FALSE'}, {t.top_k}, {t.final_event_cap}, {t.max_content_chars})"
            )
            for a, alt in enumerate(q.alternatives):
                for c, clause in enumerate(alt):
                    for ph in clause:
                        prows.append(f"({lit(t.name)}, {i}, {a}, {c}, {len(alt)}, {lit(ph.lower())})")
    q = (
        "queries(task_name, query_idx, query_text, exclude_hosts, primary_fails, top_k, final_event_cap, max_content_chars) AS "
        f"(VALUES {', '.join(qrows)})"
    )
    p = f"phrases(task_name, query_idx, alt_idx, clause_idx, n_clauses, phrase) AS (VALUES {', '.join(prows)})"
    return q + ",\n" + p


def hits_ctes(cfg: TaskConfig, src: str = "page_base", id_col: str = "page_id", prefix: str = "", with_config: bool = True) -> list[str]:
    """P6 -> P1/P3/P4 -> D1 -> W1 (all ranks in ``ranked_hits``) -> T1 (``hits``).
    CTE names get ``prefix``; the config CTEs are emitted when ``with_config``."""
    p = prefix
    search = "lower(concat_ws(' ', page_title, body_text))"
    blocked = host_allowed("h.domain", cfg.blocked_host_tokens)
    ctes = [queries_values(cfg)] if with_config else []
    return ctes + [
        f"{p}searchable AS (SELECT {id_col} AS src_pos, page_title AS title, url, normalized_url, domain, "
        f"{excerpt('body_text')} AS snippet, {search} AS search FROM {src})",
        f"{p}clause_hits AS (SELECT p.task_name, p.query_idx, p.alt_idx, p.n_clauses, s.src_pos, count(DISTINCT p.clause_idx) AS n "
        f"FROM {p}searchable s JOIN phrases p ON strpos(s.search, p.phrase) > 0 GROUP BY ALL)",
        f"{p}matched AS (SELECT DISTINCT task_name, query_idx, src_pos FROM {p}clause_hits WHERE n = n_clauses)",
        f"{p}answered AS (SELECT m.task_name, m.query_idx, h.* EXCLUDE (search), q.top_k, q.primary_fails, "
        f"row_number() OVER (PARTITION BY m.task_name, m.query_idx ORDER BY m.src_pos) AS place FROM {p}matched m "
        f"JOIN {p}searchable h ON h.src_pos = m.src_pos JOIN queries q ON q.task_name = m.task_name AND q.query_idx = m.query_idx "
        "WHERE NOT coalesce(list_bool_or(list_transform(q.exclude_hosts, lambda x: h.domain = x OR ends_with(h.domain, '.' || x))), FALSE))",
        f"{p}allowed AS (SELECT * FROM {p}answered h WHERE h.title <> '' AND h.normalized_url <> '' AND {blocked})",
        # the fallback provider returns top_k results before the filters
        f"{p}valid AS (SELECT * EXCLUDE (place, primary_fails) FROM {p}allowed WHERE NOT primary_fails OR place <= top_k)",
        f"{p}first_url AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx, normalized_url ORDER BY src_pos) AS rn FROM {p}valid) WHERE rn = 1)",
        f"{p}all_first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx, normalized_url ORDER BY src_pos) AS rn FROM {p}allowed) WHERE rn = 1)",
        f"{p}all_ranked AS (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx ORDER BY src_pos) AS rank FROM {p}all_first)",
        f"{p}ranked_hits AS (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx ORDER BY src_pos) AS rank FROM {p}first_url)",
        f"{p}hits AS (SELECT {lit(cfg.run_id)} AS run_id, r.task_name, r.query_idx, "
        "CASE WHEN q.primary_fails THEN 'fallback' ELSE 'primary' END AS provider, "
        f"CASE WHEN q.primary_fails THEN {region('q.query_text')} ELSE '' END AS region, r.rank, r.title, r.url, r.normalized_url, "
        "r.domain, r.snippet, r.query_idx::BIGINT * 4294967296 + r.rank AS arrival_seq, r.src_pos, q.top_k, q.final_event_cap, q.max_content_chars "
        f"FROM {p}ranked_hits r JOIN queries q ON q.task_name = r.task_name AND q.query_idx = r.query_idx WHERE r.rank <= q.top_k)",
    ]


def ranked_ctes(cfg: TaskConfig) -> list[str]:
    """rhits: the hits of ``hits_ctes`` ranked by BM25 over the words of the query's phrases."""
    return [
        "rt AS (SELECT src_pos, regexp_extract_all(search, '[\\p{L}\\p{N}]+') AS terms FROM searchable)",
        "rs AS (SELECT count(*) AS pages, sum(len(terms)) AS terms FROM rt WHERE len(terms) > 0)",
        "rq AS (SELECT DISTINCT task_name, query_idx, unnest(regexp_extract_all(phrase, '[\\p{L}\\p{N}]+')) AS term FROM phrases)",
        "ro AS (SELECT src_pos, n, term, count(*) AS tf FROM (SELECT src_pos, len(terms) AS n, unnest(terms) AS term FROM rt) "
        "WHERE term IN (SELECT term FROM rq) GROUP BY ALL)",
        "rw AS (SELECT term, floor(1000000.0::DOUBLE * ln(1.0::DOUBLE + (any_value(pages) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)))::BIGINT AS idf "
        "FROM ro, rs GROUP BY term)",
        "rc AS (SELECT rq.task_name, rq.query_idx, ro.src_pos, sum(rw.idf * floor(1000000.0::DOUBLE * (ro.tf * 2.2::DOUBLE) / "
        "(ro.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * (ro.n / (rs.terms::DOUBLE / rs.pages)))))::BIGINT)::BIGINT AS score "
        "FROM rq JOIN ro USING (term) JOIN rw USING (term), rs GROUP BY ALL)",
        "ra AS (SELECT a.* EXCLUDE (place), coalesce(rc.score, 0) AS score, "
        "row_number() OVER (PARTITION BY a.task_name, a.query_idx ORDER BY coalesce(rc.score, 0) DESC, a.src_pos) AS place "
        "FROM answered a LEFT JOIN rc USING (task_name, query_idx, src_pos))",
        f"rv AS (SELECT * FROM ra h WHERE h.title <> '' AND h.normalized_url <> '' AND {host_allowed('h.domain', cfg.blocked_host_tokens)} "
        "AND (NOT h.primary_fails OR h.place <= h.top_k))",
        "rf AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx, normalized_url ORDER BY score DESC, src_pos) AS rn FROM rv) WHERE rn = 1)",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY task_name, query_idx ORDER BY score DESC, src_pos) AS rank FROM rf)",
        "rhits AS (SELECT r.*, q.query_text FROM rk r JOIN queries q USING (task_name, query_idx) WHERE r.rank <= r.top_k)",
    ]


def snapshot_ctes(hits: str = "hits") -> list[str]:
    """snap(normalized_url, page_id, page_title, readable_text) for hit URLs."""
    return [
        f"snap0 AS (SELECT normalized_url, min(page_id) AS page_id FROM page_base WHERE normalized_url IN (SELECT normalized_url FROM {hits}) GROUP BY normalized_url)",
        "snap AS (SELECT s.normalized_url, s.page_id, b.page_title, b.readable_text FROM snap0 s JOIN page_base b ON b.page_id = s.page_id)",
    ]


def resolve_ctes(cfg: TaskConfig, hits: str = "hits") -> list[str]:
    e = resolved_expr("s.page_id IS NOT NULL", "s.page_title", "s.readable_text", "h.title", "h.snippet", "h.max_content_chars")
    return snapshot_ctes(hits) + [
        f"rv0 AS (SELECT h.*, s.page_id IS NOT NULL AS found, {e['title']} AS rtitle, {e['cleaned']} AS cleaned "
        f"FROM {hits} h LEFT JOIN snap s ON s.normalized_url = h.normalized_url)",
        "resolved AS (SELECT run_id, task_name, arrival_seq, normalized_url AS url, normalized_url, rtitle AS title, snippet, domain, "
        "CASE WHEN found AND cleaned = '' THEN snippet ELSE cleaned END AS content, "
        "length(CASE WHEN found AND cleaned = '' THEN snippet ELSE cleaned END) AS content_chars, "
        f"CASE WHEN NOT found THEN {lit(K.STATUS_FALLBACK_PREFIX + 'HTTPError')} WHEN cleaned <> '' THEN {lit(K.STATUS_OK)} "
        f"ELSE {lit(K.STATUS_EMPTY)} END AS fetch_status, "
        f"{lit(cfg.run_ts.replace(' ', 'T'))} AS fetched_at, {domain_score('domain')} AS domain_score, final_event_cap FROM rv0)",
    ]
