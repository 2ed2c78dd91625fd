"""Registered queries: one per inventory item, each a Spark job over the driver
tables, with the DuckDB oracle SQL of the same result where one exists.

Keys carry the inventory id as prefix.  Every query reads whole tables (pages,
documents or events) and, for hit-based queries, the task configuration
``PROSE_CONFIG`` (queries over words of the tables' own prose).  Integral
outputs are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import dates as DT
from ..functions import scoring as R
from ..functions import text as X
from ..functions import urls as U
from ..operators import clusters as C
from ..operators import hits as HT
from ..operators import report as RP
from ..operators import similarity as S
from ..operators.components import component_labels
from ..operators.dedup import dedupe_pages, url_dedup
from ..operators.features import page_features
from ..operators.leader import leader_labels
from ..operators.pages import CORPUS_TASK, page_base, pages_as_resolved
from ..operators.replies import parse_replies, render_replies
from ..operators.phrases import phrase_matches
from ..operators.resolve import resolve_hits
from ..operators.retrieval import ranked_hits
from ..session import ensure_checkpoint_dir
from ..sources import tables
from ..sources.tasks import PROSE_CONFIG
from . import oracle as O
from .triage import cluster_labels, run_triage, triage_report

CFG = PROSE_CONFIG
CORPUS_CAP = 20
EXCLUDE_HOSTS = ("example.org", "blog.ththan.example.net")
DOC_HOST_SUFFIX = ".docs.example.com/doc/"
DOC_TITLE_CHARS = 80
DOC_SEQ = 1 << 31

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _longs(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (lambda spark, sf_dir: _longs(fn(spark, sf_dir)), sql)
        return fn

    return deco


# ---------------------------------------------------------------- shared Spark inputs


def _pages(spark, sf):
    return tables.pages(spark, sf)


def _base(spark, sf, main=True):
    return page_base(_pages(spark, sf), with_main=main)


def _resolved(spark, sf):
    """Cut once: the dedup elections and the rows they keep both read it."""
    ensure_checkpoint_dir(spark)
    return pages_as_resolved(_pages(spark, sf)).checkpoint()


def _features(spark, sf):
    """Features of the URL winners (D2).  The run itself clusters title winners
    (D3); here pages of one title stay, so that the merge rules have work."""
    return page_features(url_dedup(_resolved(spark, sf)).withColumn("seq", F.col("first_seen")))


def _versioned_features(spark, sf):
    """Features of the URL winners with a version in their titles (the tables
    name hardly any): that of an even or an odd page_id."""
    d2 = url_dedup(_resolved(spark, sf))
    version = F.concat(F.lit(" 1."), F.pmod("arrival_seq", F.lit(2)).cast("string"))
    return page_features(d2.withColumns({"seq": F.col("first_seen"), "title": F.concat("title", version)}))


def _corpus_clusters(spark, sf):
    feats = _features(spark, sf).checkpoint()
    edges = S.merge_edges(feats, input_is_cut=True, spanning=True).checkpoint()
    labels = component_labels(feats.select("run_id", "task_name", "seq"), edges)
    members = C.assign(feats, labels)
    summary = C.summarize(members)
    ranked = C.rank(summary, cap=CORPUS_CAP)
    return feats, edges, labels, members, summary, ranked


def _hits(spark, sf):
    qdim = HT.query_dimension(spark, CFG)
    return HT.search_hits(_base(spark, sf, main=False), qdim, CFG)


# ---------------------------------------------------------------- shared oracle CTEs

PB = O.page_base_ctes(True)
PB_NOMAIN = O.page_base_ctes(False)
CORPUS = O.pages_resolved_ctes() + O.dedup_ctes() + ["dz AS (SELECT *, first_seen AS seq FROM d2)"] + O.feature_ctes("dz")
CLUSTERS = CORPUS + O.edge_ctes() + O.component_ctes() + O.cluster_ctes(str(CORPUS_CAP))
HITS = PB + O.hits_ctes(CFG)


def _sql(ctes, final):
    return O.with_(ctes, final)


def _sqlr(ctes, final):
    return O.with_recursive(ctes, final)


# ================================================================ U*, P*, F*, R* on pages


@register(
    "u1_redirect",
    _sql(
        ["w0 AS (SELECT page_id, " + O.ws("url") + " AS url FROM pages)",
         "w1 AS (SELECT page_id, url, 'https://duckduckgo.com/l/?uddg=' || " + O.form_encode("url") + " || '&rut=x1' AS wrapped FROM w0)"]
        + O.url_ctes("w1", "wrapped", "page_id, url, wrapped", "uw_a")
        + O.url_ctes("w1", "url", "page_id", "uw_b"),
        "SELECT a.page_id, a.wrapped AS wrapped_url, a.unwrapped AS unwrapped_url, b.unwrapped AS direct_url "
        "FROM uw_a a JOIN uw_b b USING (page_id)",
    ),
)
def u1_redirect(spark, sf):
    p = _pages(spark, sf).select("page_id", X.normalize_ws("url").alias("url"))
    p = p.withColumn(
        "wrapped_url", F.concat(F.lit("https://duckduckgo.com/l/?uddg="), U.form_encode("url"), F.lit("&rut=x1"))
    )
    return p.select(
        "page_id",
        "wrapped_url",
        U.unwrap_redirect("wrapped_url").alias("unwrapped_url"),
        U.unwrap_redirect("url").alias("direct_url"),
    )


@register(
    "u2_normalize_url",
    _sql(["n0 AS (SELECT page_id, " + O.ws("url") + " AS url FROM pages)"] + O.url_ctes("n0", "url", "page_id, url", "nu"),
         "SELECT page_id, url, normalized_url FROM nu"),
)
def u2_normalize_url(spark, sf):
    p = _pages(spark, sf).select("page_id", X.normalize_ws("url").alias("url"))
    return U.with_canonical_url(p, "url", domain_col=None)


@register("u3_domain", _sql(PB_NOMAIN, "SELECT page_id, domain FROM page_base"))
def u3_domain(spark, sf):
    return _base(spark, sf, main=False).select("page_id", "domain")


@register(
    "p1_valid_hits",
    _sql(PB_NOMAIN, "SELECT page_id, page_title AS title, normalized_url FROM page_base WHERE page_title <> '' AND normalized_url <> ''"),
)
def p1_valid_hits(spark, sf):
    b = _base(spark, sf, main=False)
    return b.filter((F.col("page_title") != "") & (F.col("normalized_url") != "")).select(
        "page_id", F.col("page_title").alias("title"), "normalized_url"
    )


@register(
    "p3_host_allowed",
    _sql(PB_NOMAIN, f"SELECT page_id, domain FROM page_base WHERE {O.host_allowed('domain', CFG.blocked_host_tokens)}"),
)
def p3_host_allowed(spark, sf):
    b = _base(spark, sf, main=False)
    return b.filter(U.host_allowed(F.col("domain"), CFG.blocked_host_tokens)).select("page_id", "domain")


@register(
    "p4_site_exclusion",
    _sql(
        PB_NOMAIN,
        "SELECT page_id, domain FROM page_base WHERE NOT coalesce(list_bool_or(list_transform("
        + O.str_list(EXCLUDE_HOSTS)
        + ", lambda x: domain = x OR ends_with(domain, '.' || x))), FALSE)",
    ),
)
def p4_site_exclusion(spark, sf):
    b = _base(spark, sf, main=False)
    excl = F.array(*[F.lit(h) for h in EXCLUDE_HOSTS])
    return b.filter(~U.excluded_by_site(F.col("domain"), excl)).select("page_id", "domain")


@register("x4_title_key", _sql(PB_NOMAIN, f"SELECT page_id, {O.title_key('page_title')} AS title_key FROM page_base"))
def x4_title_key(spark, sf):
    return _base(spark, sf, main=False).select("page_id", X.title_key("page_title").alias("title_key"))


@register(
    "f1_page_text",
    _sql(PB_NOMAIN, "SELECT page_id, page_title AS title, length(body_text) AS n_chars, md5(body_text) AS text_md5 FROM page_base"),
)
def f1_page_text(spark, sf):
    b = _base(spark, sf, main=False)
    return b.select(
        "page_id", F.col("page_title").alias("title"), F.length("body_text").alias("n_chars"), F.md5("body_text").alias("text_md5")
    )


@register(
    "f2_main_content",
    _sql(PB, "SELECT page_id, length(main_text) AS n_chars, md5(main_text) AS text_md5, md5(readable_text) AS readable_md5 FROM page_base"),
)
def f2_main_content(spark, sf):
    b = _base(spark, sf, main=True)
    return b.select(
        "page_id",
        F.length("main_text").alias("n_chars"),
        F.md5("main_text").alias("text_md5"),
        F.md5("readable_text").alias("readable_md5"),
    )


#: By page_id modulo 4: text to look for, and what takes its place: dropped elements inside themselves, closed by an element
#: around them, never closed, and closed after stray end tags.
BROKEN_HTML = (
    ("<article>", "<header><div><header>in</header>mid</div>tail</header><article>"),
    ("<article>", "<div><nav>open<p>menu</div><article>"),
    ("</nav>", ""),
    ("</p>", "</p></nav></div><section><footer>open <b>still</section>"),
)


def _broken_sql():
    cases = " ".join(f"WHEN {i} THEN replace(html, {O.lit(old)}, {O.lit(new)})" for i, (old, new) in enumerate(BROKEN_HTML))
    broken = f"broken AS (SELECT page_id, url, CASE page_id % 4 {cases} END AS html FROM pages)"
    return _sql(
        [broken] + O.page_base_ctes(True, "broken"),
        "SELECT page_id, length(body_text) AS n_chars, md5(body_text) AS text_md5, length(main_text) AS n_main_chars, md5(main_text) AS main_md5 FROM page_base",
    )


@register("f1_broken_html", _broken_sql())
def f1_broken_html(spark, sf):
    """F1 and F2 on the pages with their HTML broken."""
    html = F.col("html")
    for i, (old, new) in enumerate(BROKEN_HTML):
        html = F.when(F.col("page_id") % 4 == i, F.replace(F.col("html"), F.lit(old), F.lit(new))).otherwise(html)
    b = page_base(_pages(spark, sf).withColumn("html", html))
    return b.select(
        "page_id",
        F.length("body_text").alias("n_chars"),
        F.md5("body_text").alias("text_md5"),
        F.length("main_text").alias("n_main_chars"),
        F.md5("main_text").alias("main_md5"),
    )


@register("r1_domain_score", _sql(PB_NOMAIN, f"SELECT page_id, domain, {O.domain_score('domain')}::BIGINT AS domain_score FROM page_base"))
def r1_domain_score(spark, sf):
    return _base(spark, sf, main=False).select("page_id", "domain", R.domain_score("domain").alias("domain_score"))


@register("r2_official_bonus", _sql(PB_NOMAIN, f"SELECT page_id, domain, {O.official_bonus('domain')}::BIGINT AS official_bonus FROM page_base"))
def r2_official_bonus(spark, sf):
    return _base(spark, sf, main=False).select("page_id", "domain", R.official_bonus("domain").alias("official_bonus"))


# ================================================================ X*, L*, P6 on documents

DOC_WS = O.ws("text")


@register("x1_whitespace", f"SELECT doc_id, length({DOC_WS}) AS n_chars, md5({DOC_WS}) AS text_md5 FROM documents")
def x1_whitespace(spark, sf):
    d = tables.documents(spark, sf)
    t = X.normalize_ws("text")
    return d.select("doc_id", F.length(t).alias("n_chars"), F.md5(t).alias("text_md5"))


_X2 = O.clean_text("text", str(K.DEFAULT_MAX_CONTENT_CHARS))


@register("x2_clean_text", f"SELECT doc_id, length({_X2}) AS n_chars, md5({_X2}) AS text_md5 FROM documents")
def x2_clean_text(spark, sf):
    d = tables.documents(spark, sf)
    return d.select("doc_id", X.clean_text("text", K.DEFAULT_MAX_CONTENT_CHARS).alias("c")).select(
        "doc_id", F.length("c").alias("n_chars"), F.md5("c").alias("text_md5")
    )


@register("x3_excerpt", f"SELECT doc_id, {O.excerpt('text')} AS excerpt FROM documents")
def x3_excerpt(spark, sf):
    return tables.documents(spark, sf).select("doc_id", X.excerpt("text").alias("excerpt"))


@register(
    "x5_tokens",
    f"SELECT doc_id, len({O.tokens('text')}) AS n_tokens, md5(array_to_string({O.tokens('text')}, ' ')) AS tokens_md5 FROM documents",
)
def x5_tokens(spark, sf):
    d = tables.documents(spark, sf).select("doc_id", X.tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@register("x9_version", f"SELECT doc_id, {O.version_of('lower(' + DOC_WS + ')')} AS version FROM documents")
def x9_version(spark, sf):
    d = tables.documents(spark, sf)
    return d.select("doc_id", X.version_token(F.lower(X.normalize_ws("text"))).alias("version"))


@register("l1_region", f"SELECT doc_id, {O.region('text')} AS region FROM documents")
def l1_region(spark, sf):
    return tables.documents(spark, sf).select("doc_id", X.region("text").alias("region"))


@register("l2_language", f"SELECT doc_id, {O.language('text')} AS language FROM documents")
def l2_language(spark, sf):
    return tables.documents(spark, sf).select("doc_id", X.language_hint("text").alias("language"))


@register(
    "p6_keyword_match",
    _sql(
        [O.queries_values(CFG),
         f"ds AS (SELECT doc_id, lower({DOC_WS}) AS search FROM documents)",
         "ch AS (SELECT p.task_name, p.query_idx, p.alt_idx, p.n_clauses, d.doc_id, count(DISTINCT p.clause_idx) AS n "
         "FROM ds d JOIN phrases p ON strpos(d.search, p.phrase) > 0 GROUP BY ALL)"],
        "SELECT DISTINCT task_name, query_idx::BIGINT AS query_idx, doc_id FROM ch WHERE n = n_clauses",
    ),
)
def p6_keyword_match(spark, sf):
    d = tables.documents(spark, sf).select("doc_id", F.lower(X.normalize_ws("text")).alias("search"))
    (queries,) = HT.query_chunks(CFG)
    m = d.select("doc_id", F.explode(HT.matching_queries(F.col("search"), queries)).alias("q"))
    return m.select("q.task_name", "q.query_idx", "doc_id")


#: The dictionary of p6_phrase_dictionary: per benchmark item, its words 1-2 and its words 4-5, or its words 6-8.
ITEM_PHRASES = ((0, 0, 1, 2), (0, 1, 4, 2), (1, 0, 6, 3))


def _item_formulas(spark, sf):
    items = tables.read_table(spark, sf, "benchmark")
    words = F.split(F.lower(X.normalize_ws("text")), " ")
    phrase = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    rows = F.array(*[F.struct(F.lit(a).alias("alt"), F.lit(c).alias("clause"), phrase(first, n).alias("phrase")) for a, c, first, n in ITEM_PHRASES])
    return items.select("item_id", F.inline(rows))


_ITEM_SQL = " UNION ALL ".join(
    f"SELECT item_id, {a} AS alt, {c} AS clause, array_to_string(w[{first}:{first + n - 1}], ' ') AS phrase FROM iw" for a, c, first, n in ITEM_PHRASES
)


@register(
    "p6_phrase_dictionary",
    _sql(
        [f"iw AS (SELECT item_id, string_split(lower({O.ws('text')}), ' ') AS w FROM benchmark)",
         f"ip AS ({_ITEM_SQL})",
         f"ds AS (SELECT doc_id, lower({DOC_WS}) AS search FROM documents)",
         "ic AS (SELECT d.doc_id, ip.item_id, ip.alt, count(DISTINCT ip.clause) AS n FROM ds d JOIN ip ON strpos(d.search, ip.phrase) > 0 GROUP BY ALL)"],
        "SELECT DISTINCT doc_id, item_id FROM ic WHERE n = CASE alt WHEN 0 THEN 2 ELSE 1 END",
    ),
)
def p6_phrase_dictionary(spark, sf):
    """P6 with a dictionary of phrases out of a table."""
    ensure_checkpoint_dir(spark)
    d = tables.documents(spark, sf).select(F.col("doc_id").alias("id"), F.lower(X.normalize_ws("text")).alias("text"))
    return phrase_matches(d, _item_formulas(spark, sf), ["item_id"]).select(F.col("id").alias("doc_id"), "item_id")


# ================================================================ P5, N2 on events

_P5_SQL = f"SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '{CFG.run_ts[:19]}' - INTERVAL 1 MONTH"


@register("p5_recency", _P5_SQL)
def p5_recency(spark, sf):
    e = tables.events(spark, sf)
    return HT.recent(e, "ts", CFG.run_ts).select("event_id", "user_id", "event_type")


#: How the pages of p5_page_dates name their date, by page_id modulo 6; the others name none.
DATE_TAGS = (
    '<meta property="article:published_time" content="{}T10:30:00+08:00">',
    "<meta content='{} 23:15' name='pubdate'>",
    '<script type="application/ld+json">{{"@type": "Article", "datePublished": "{}T00:10:00.250-0300"}}</script>',
    '<p><time class="t" datetime="{}">then</time></p>',
    '<meta name="date" content="long ago"><time datetime="{}T05:00:00Z">then</time>',
)
DATE_SPAN = 90


def _page_dates_sql():
    day = f"strftime(DATE '{CFG.run_ts[:10]}' - (page_id * 7 % {DATE_SPAN})::INT, '%Y-%m-%d')"
    tag = " ".join(f"WHEN {i} THEN concat({', '.join((O.lit(a), day, O.lit(b)))})" for i, t in enumerate(DATE_TAGS) for a, b in [[x.replace('{{', '{').replace('}}', '}') for x in t.split('{}')]])
    iso = O.lit(DT.ISO_RE)
    parsed = lambda v: (
        f"CASE WHEN regexp_matches({v}, {iso}) THEN try_cast(regexp_extract({v}, {iso}, 1) || ' ' || CASE WHEN regexp_extract({v}, {iso}, 2) = '' THEN '00:00' "
        f"ELSE regexp_extract({v}, {iso}, 2) END || CASE WHEN regexp_extract({v}, {iso}, 3) IN ('', 'Z', 'z') THEN '+00' "
        f"ELSE regexp_replace(regexp_extract({v}, {iso}, 3), '([0-9]{{2}}):?([0-9]{{2}})$', '\\1:\\2') END AS TIMESTAMPTZ) END"
    )
    values = ", ".join(parsed(f"regexp_extract(html, {O.lit(p)}, 1)") for p in DT.DATE_PATTERNS)
    return _sql(
        [f"pd AS (SELECT page_id, concat(CASE page_id % 6 {tag} ELSE '' END, html) AS html FROM pages)",
         f"pi AS (SELECT page_id, epoch(coalesce({values}))::BIGINT AS published FROM pd)"],
        f"SELECT page_id, published FROM pi WHERE published >= epoch(TIMESTAMP '{CFG.run_ts[:19].replace('T', ' ')}' - INTERVAL 1 MONTH)",
    )


@register("p5_page_dates", _page_dates_sql())
def p5_page_dates(spark, sf):
    """P5 on the dates that pages name."""
    day = F.date_format(F.date_sub(F.lit(CFG.run_ts[:10]).cast("date"), (F.col("page_id") * 7 % DATE_SPAN).cast("int")), "yyyy-MM-dd")
    tag = F.lit("")
    for i, t in enumerate(DATE_TAGS):
        before, after = (x.replace("{{", "{").replace("}}", "}") for x in t.split("{}"))
        tag = F.when(F.col("page_id") % 6 == i, F.concat(F.lit(before), day, F.lit(after))).otherwise(tag)
    dated = _pages(spark, sf).select("page_id", DT.published_at(F.concat(tag, F.col("html"))).alias("published"))
    return HT.recent(dated, "published", CFG.run_ts).select("page_id", F.unix_timestamp(F.col("published").cast("timestamp")).alias("published"))


@register("n2_slug", "SELECT event_id, strftime(ts, '%Y_%m_%d_%H%M%S') AS slug FROM events")
def n2_slug(spark, sf):
    return tables.events(spark, sf).select("event_id", RP.slug(F.col("ts")).alias("slug"))


# ================================================================ hits: S*, D1, W1, T1, O1, J1

_HIT_COLS = "task_name, query_idx::BIGINT AS query_idx, provider, region, rank, title, url, normalized_url, domain, snippet, arrival_seq"


@register("s3_hits", _sql(HITS, f"SELECT {_HIT_COLS} FROM hits"))
def s3_hits(spark, sf):
    return _hits(spark, sf).select(
        "task_name", "query_idx", "provider", "region", "rank", "title", "url", "normalized_url", "domain", "snippet", "arrival_seq"
    )


@register(
    "s3_ranked_hits",
    _sql(
        HITS + O.ranked_ctes(CFG),
        "SELECT task_name, query_idx::BIGINT AS query_idx, CASE WHEN primary_fails THEN 'fallback' ELSE 'primary' END AS provider, "
        "rank, score, title, url, normalized_url, domain, snippet, src_pos FROM rhits",
    ),
)
def s3_ranked_hits(spark, sf):
    """S3 in order of relevance."""
    found = ranked_hits(_pages(spark, sf), HT.query_dimension(spark, CFG), CFG)
    return found.select("task_name", "query_idx", "provider", "rank", "score", "title", "url", "normalized_url", "domain", "snippet", "src_pos")


@register(
    "s1_task_bounds",
    _sql(
        HITS,
        "SELECT q.task_name, count(*) AS n_queries, any_value(q.top_k)::BIGINT AS top_k, (count(*) * any_value(q.top_k))::BIGINT AS hit_bound, "
        "any_value(q.final_event_cap)::BIGINT AS final_event_cap, any_value(q.max_content_chars)::BIGINT AS max_content_chars, "
        "(SELECT count(*) FROM hits h WHERE h.task_name = q.task_name) AS n_hits FROM queries q GROUP BY q.task_name",
    ),
)
def s1_task_bounds(spark, sf):
    qdim = HT.query_dimension(spark, CFG)
    per_task = qdim.groupBy("task_name").agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.first("top_k").alias("top_k"),
        F.first("final_event_cap").alias("final_event_cap"),
        F.first("max_content_chars").alias("max_content_chars"),
    )
    n_hits = _hits(spark, sf).groupBy("task_name").agg(F.count(F.lit(1)).alias("n_hits"))
    out = per_task.join(n_hits, "task_name", "left")
    return out.select(
        "task_name",
        "n_queries",
        "top_k",
        (F.col("n_queries") * F.col("top_k")).alias("hit_bound"),
        "final_event_cap",
        "max_content_chars",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
    )


@register(
    "s5_fallback",
    _sql(HITS, "SELECT task_name, query_idx::BIGINT AS query_idx, provider, region, count(*) AS n_hits FROM hits GROUP BY ALL"),
)
def s5_fallback(spark, sf):
    return _hits(spark, sf).groupBy("task_name", "query_idx", "provider", "region").agg(F.count(F.lit(1)).alias("n_hits"))


def _d1_sql():
    ctes = PB_NOMAIN + [
        O.queries_values(CFG),
        "pb2 AS (SELECT page_id AS pos, * FROM page_base UNION ALL SELECT page_id + 1000000000000 AS pos, * FROM page_base)",
        f"sr AS (SELECT pos AS src_pos, page_title AS title, normalized_url, domain, lower(concat_ws(' ', page_title, body_text)) AS search FROM pb2)",
        "chh AS (SELECT p.task_name, p.query_idx, p.alt_idx, p.n_clauses, s.src_pos, count(DISTINCT p.clause_idx) AS n "
        "FROM sr s JOIN phrases p ON strpos(s.search, p.phrase) > 0 GROUP BY ALL)",
        "mt AS (SELECT DISTINCT task_name, query_idx, src_pos FROM chh WHERE n = n_clauses)",
        "vl AS (SELECT m.task_name, m.query_idx, s.src_pos, s.normalized_url FROM mt m JOIN sr s USING (src_pos) "
        "JOIN queries q ON q.task_name = m.task_name AND q.query_idx = m.query_idx "
        f"WHERE s.title <> '' AND s.normalized_url <> '' AND {O.host_allowed('s.domain', CFG.blocked_host_tokens)} "
        "AND NOT coalesce(list_bool_or(list_transform(q.exclude_hosts, lambda x: s.domain = x OR ends_with(s.domain, '.' || x))), FALSE))",
    ]
    return _sql(ctes, "SELECT task_name, query_idx::BIGINT AS query_idx, normalized_url, min(src_pos) AS src_pos FROM vl GROUP BY ALL")


@register("d1_query_dedup", _d1_sql())
def d1_query_dedup(spark, sf):
    b = _base(spark, sf, main=False)
    twice = b.unionByName(b.withColumn("page_id", F.col("page_id") + F.lit(1_000_000_000_000)))
    h = HT.keyword_hits(twice, CFG, CFG.blocked_host_tokens).filter("valid")
    return HT.first_per_url(h.select("task_name", "query_idx", "normalized_url", "src_pos"))


@register("w1_rank", _sql(HITS, "SELECT task_name, query_idx::BIGINT AS query_idx, normalized_url, rank FROM all_ranked"))
def w1_rank(spark, sf):
    """W1 over all kept hits (no top-k): positions per query without a
    one-task window (a query may match a third of all pages)."""
    from ..operators.ranking import positions

    b = _base(spark, sf, main=False)
    h = HT.first_per_url(HT.keyword_hits(b, CFG, CFG.blocked_host_tokens).filter("valid").select("task_name", "query_idx", "normalized_url", "src_pos"))
    return positions(h, ["task_name", "query_idx"], [F.col("src_pos")], "rank").select("task_name", "query_idx", "normalized_url", "rank")


@register("t1_topk", _sql(HITS, "SELECT task_name, query_idx::BIGINT AS query_idx, rank, normalized_url FROM hits"))
def t1_topk(spark, sf):
    return _hits(spark, sf).select("task_name", "query_idx", "rank", "normalized_url")


@register(
    "o1_union_hits",
    _sql(HITS, "SELECT task_name, normalized_url, count(DISTINCT query_idx) AS n_queries, min(arrival_seq) AS first_arrival FROM hits GROUP BY ALL"),
)
def o1_union_hits(spark, sf):
    return _hits(spark, sf).groupBy("task_name", "normalized_url").agg(
        F.countDistinct("query_idx").alias("n_queries"), F.min("arrival_seq").alias("first_arrival")
    )


@register(
    "j1_hits_pages",
    _sql(
        HITS + O.snapshot_ctes("hits"),
        "SELECT h.task_name, h.query_idx::BIGINT AS query_idx, h.rank, h.normalized_url, s.page_id "
        "FROM hits h LEFT JOIN snap s ON s.normalized_url = h.normalized_url",
    ),
)
def j1_hits_pages(spark, sf):
    from ..operators.resolve import matching_pages, sized_broadcast

    h = _hits(spark, sf).checkpoint()
    urls = sized_broadcast(h.select("normalized_url").distinct(), CFG.hit_bound)
    found = matching_pages(tables.read_table(spark, sf, "pages"), urls)
    return h.join(found, "normalized_url", "left").select("task_name", "query_idx", "rank", "normalized_url", "page_id")


# ---- S6 over page hits and document hits (documents have no crawled page)


def _doc_base(spark, sf):
    d = tables.documents(spark, sf)
    df = d.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(DOC_HOST_SUFFIX), F.col("doc_id").cast("string")).alias("url"),
        X.excerpt("text", DOC_TITLE_CHARS).alias("page_title"),
        X.normalize_ws("text").alias("body_text"),
    )
    return U.with_canonical_url(df, "url")


def _doc_base_ctes():
    pre = (
        "db0 AS (SELECT doc_id AS page_id, 'https://' || source || " + O.lit(DOC_HOST_SUFFIX) + " || doc_id::VARCHAR AS url, "
        + O.excerpt("text", DOC_TITLE_CHARS) + " AS page_title, " + O.ws("text") + " AS body_text FROM documents)"
    )
    return [pre] + O.url_ctes("db0", "url", "page_id, url, page_title, body_text", "doc_base")


def _s6_sql():
    ctes = HITS + _doc_base_ctes() + O.hits_ctes(CFG, src="doc_base", prefix="d", with_config=False) + [
        "allhits AS (SELECT * FROM hits UNION ALL SELECT * REPLACE ('documents' AS provider, arrival_seq + 2147483648 AS arrival_seq) FROM dhits)"
    ] + O.resolve_ctes(CFG, "allhits")
    return _sql(
        ctes,
        "SELECT task_name, arrival_seq, title, url, content_chars, md5(content) AS content_md5, fetch_status FROM resolved",
    )


@register("s6_resolve", _s6_sql())
def s6_resolve(spark, sf):
    qdim = HT.query_dimension(spark, CFG)
    page_hits = HT.search_hits(_base(spark, sf, main=False), qdim, CFG)
    doc_hits = HT.search_hits(_doc_base(spark, sf), qdim, CFG).withColumns(
        {"provider": F.lit("documents"), "arrival_seq": F.col("arrival_seq") + F.lit(2147483648)}
    )
    hits = page_hits.unionByName(doc_hits)
    res = resolve_hits(hits, _pages(spark, sf), CFG.run_ts, hit_bound=2 * CFG.hit_bound)
    return res.select(
        "task_name", "arrival_seq", "title", "url", "content_chars", F.md5("content").alias("content_md5"), "fetch_status"
    )


# ---- S2 replies rendered from hits, parsed back


def _s2_sql():
    item = (
        "rank::VARCHAR || '. **' || title || '**' || chr(10) || '   URL: ' || url || chr(10) || '(' || provider || ') ' || snippet"
    )
    ctes = HITS + [
        f"rep AS (SELECT task_name, query_idx, 'Search Results for query ' || query_idx::VARCHAR || chr(10) || "
        f"string_agg({item}, chr(10) ORDER BY rank) AS body FROM hits GROUP BY task_name, query_idx)",
        "ln AS (SELECT task_name, query_idx, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM rep)",
        "ln1 AS (SELECT *, regexp_replace(line, " + O.lit("^" + K.WS + "|" + K.WS + "$") + ", '', 'g') AS stripped, "
        "min(CASE WHEN strpos(line, " + O.lit(K.REPLY_SECTION_MARKER) + ") > 0 THEN pos END) OVER (PARTITION BY task_name, query_idx) AS sr_pos FROM ln)",
        "ln2 AS (SELECT *, strpos(line, " + O.lit(K.REPLY_SECTION_MARKER) + ") > 0 AS is_sr, "
        + "regexp_matches(stripped, " + O.lit("^" + K.REPLY_TITLE_LINE) + ") AS is_title FROM ln1 WHERE pos > sr_pos)",
        "ln3 AS (SELECT *, is_title AND NOT is_sr AS t, sum(CASE WHEN is_title AND NOT is_sr THEN 1 ELSE 0 END) OVER "
        "(PARTITION BY task_name, query_idx ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS item_no FROM ln2)",
        "ln4 AS (SELECT *, NOT is_sr AND NOT t AND regexp_matches(line, " + O.lit("^" + K.REPLY_URL_LINE) + ") AS is_url, "
        "NOT is_sr AND NOT t AND starts_with(stripped, '(') AS is_paren FROM ln3 WHERE item_no > 0)",
        "it AS (SELECT task_name, query_idx, item_no, "
        "any_value(CASE WHEN t THEN regexp_extract(stripped, " + O.lit("^" + K.REPLY_TITLE_LINE) + ", 1) END) AS title, "
        "min(CASE WHEN is_paren THEN pos END) AS p1 FROM ln4 GROUP BY ALL)",
        "urls AS (SELECT i.task_name, i.query_idx, i.item_no, arg_max(regexp_replace(regexp_extract(l.line, " + O.lit("^" + K.REPLY_URL_LINE) + ", 1), " + O.lit(f"^{K.WS}|{K.WS}$") + ", '', 'g'), l.pos) AS url "
        "FROM it i JOIN ln4 l ON l.task_name = i.task_name AND l.query_idx = i.query_idx AND l.item_no = i.item_no AND l.is_url AND l.pos < i.p1 GROUP BY ALL)",
        "snips AS (SELECT i.task_name, i.query_idx, i.item_no, l.stripped AS snippet FROM it i JOIN ln4 l "
        "ON l.task_name = i.task_name AND l.query_idx = i.query_idx AND l.item_no = i.item_no AND l.pos = i.p1)",
    ]
    return _sql(
        ctes,
        "SELECT i.task_name, i.query_idx::BIGINT AS query_idx, i.item_no::BIGINT AS item_no, i.title, u.url, s.snippet "
        "FROM it i JOIN urls u USING (task_name, query_idx, item_no) JOIN snips s USING (task_name, query_idx, item_no) WHERE u.url <> ''",
    )


@register("s2_parse_responses", _s2_sql())
def s2_parse_responses(spark, sf):
    replies = render_replies(_hits(spark, sf))
    return parse_replies(replies).select("task_name", "query_idx", "item_no", "title", "url", "snippet")


# ================================================================ dedup and features on the page corpus


@register(
    "d2_url_dedup",
    _sql(CORPUS, "SELECT normalized_url, arrival_seq, first_seen, domain_score::BIGINT AS domain_score, content_chars FROM d2"),
)
def d2_url_dedup(spark, sf):
    return url_dedup(_resolved(spark, sf)).select("normalized_url", "arrival_seq", "first_seen", "domain_score", "content_chars")


@register("d3_title_dedup", _sql(CORPUS, "SELECT normalized_url, title_key, seq FROM d3"))
def d3_title_dedup(spark, sf):
    return dedupe_pages(_resolved(spark, sf)).select("normalized_url", "title_key", "seq")


@register("j2_title_semi", _sql(CORPUS, "SELECT normalized_url, first_seen FROM d2 WHERE normalized_url IN (SELECT normalized_url FROM d3)"))
def j2_title_semi(spark, sf):
    """J2 as its own semi join: URL winners whose URL is among the title
    winners (the D3 aggregation)."""
    from ..operators.dedup import title_dedup

    d2 = url_dedup(_resolved(spark, sf))
    winners = title_dedup(d2).select("run_id", "task_name", "normalized_url")
    return d2.join(winners, ["run_id", "task_name", "normalized_url"], "left_semi").select("normalized_url", "first_seen")


@register(
    "x6_page_tokens",
    _sql(CORPUS, "SELECT seq, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM feat"),
)
def x6_page_tokens(spark, sf):
    f = _features(spark, sf)
    return f.select("seq", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@register("x7_title_tokens", _sql(CORPUS, "SELECT seq, array_to_string(title_tokens, ' ') AS title_tokens FROM feat"))
def x7_title_tokens(spark, sf):
    return _features(spark, sf).select("seq", F.array_join("title_tokens", " ").alias("title_tokens"))


@register("x8_signature", _sql(CORPUS, "SELECT seq, version, signature FROM feat"))
def x8_signature(spark, sf):
    return _features(spark, sf).select("seq", "version", "signature")


# ================================================================ similarity and clusters

EDGES = CORPUS + O.edge_ctes()


@register("c3_signature_pairs", _sql(EDGES, "SELECT a, b FROM e_m1 WHERE a <> b"))
def c3_signature_pairs(spark, sf):
    _, classes = S.feature_classes(_features(spark, sf))
    return S.signature_edges(classes).select("a", "b")


@register("c4_token_pairs", _sql(EDGES, "SELECT a, b FROM e_pairs WHERE m2"))
def c4_token_pairs(spark, sf):
    _, classes = S.feature_classes(_features(spark, sf))
    return S.token_edges(classes).select("a", "b")


def _c5_sql():
    dv = "dv AS (SELECT * REPLACE (title || ' 1.' || (arrival_seq % 2)::VARCHAR AS title), first_seen AS seq FROM d2)"
    ctes = O.pages_resolved_ctes() + O.dedup_ctes() + [dv] + O.feature_ctes("dv") + O.edge_ctes()
    return _sql(ctes, "SELECT a, b FROM e_pairs WHERE m3")


@register("c5_version_pairs", _c5_sql())
def c5_version_pairs(spark, sf):
    _, classes = S.feature_classes(_versioned_features(spark, sf))
    return S.version_edges(classes).select("a", "b")


@register("c6_title_pairs", _sql(EDGES, "SELECT a, b FROM e_pairs WHERE m4"))
def c6_title_pairs(spark, sf):
    _, classes = S.feature_classes(_features(spark, sf))
    return S.title_edges(classes).select("a", "b")


@register("j3_merge_edges", _sql(EDGES, "SELECT a, b, rules FROM edges"))
def j3_merge_edges(spark, sf):
    return S.merge_edges(_features(spark, sf)).select("a", "b", "rules")


@register(
    "c7_overlap",
    _sql(
        EDGES,
        "SELECT e.a, e.b, " + O.overlap_ratio("x.tokens", "y.tokens") + " AS token_overlap, "
        + O.overlap_ratio("x.title_tokens", "y.title_tokens") + " AS title_overlap "
        "FROM edges e JOIN feat x ON x.seq = e.a JOIN feat y ON y.seq = e.b",
    ),
)
def c7_overlap(spark, sf):
    f = _features(spark, sf)
    return S.pair_overlaps(S.merge_edges(f), f).select("a", "b", "token_overlap", "title_overlap")


@register("c2_components", _sqlr(CLUSTERS, "SELECT seq, label FROM labels"))
def c2_components(spark, sf):
    f = _features(spark, sf).checkpoint()
    return component_labels(f.select("run_id", "task_name", "seq"), S.merge_edges(f, input_is_cut=True, spanning=True)).select("seq", "label")


@register(
    "c8_cluster_table",
    _sqlr(CLUSTERS, "SELECT label, first_seen, rep_seq, source_count, release_signature FROM summary"),
)
def c8_cluster_table(spark, sf):
    s = _corpus_clusters(spark, sf)[4]
    return s.select("label", "first_seen", F.col("rep.seq").alias("rep_seq"), "source_count", "release_signature")


@register("d4_representative", _sqlr(CLUSTERS, "SELECT label, rep_seq, rep_url, rep_title FROM summary"))
def d4_representative(spark, sf):
    s = _corpus_clusters(spark, sf)[4]
    return s.select("label", F.col("rep.seq").alias("rep_seq"), F.col("rep.url").alias("rep_url"), F.col("rep.title").alias("rep_title"))


@register("d5_sources", _sqlr(CLUSTERS, "SELECT label, seq, title, url, domain FROM members"))
def d5_sources(spark, sf):
    m = _corpus_clusters(spark, sf)[3]
    return m.select("label", "seq", "title", "url", "domain")


@register("d6_cluster_tokens", _sqlr(CLUSTERS, "SELECT DISTINCT label, unnest(tokens) AS token FROM members"))
def d6_cluster_tokens(spark, sf):
    m = _corpus_clusters(spark, sf)[3]
    return C.cluster_tokens(m).select("label", "token")


@register("d7_cluster_signature", _sqlr(CLUSTERS, "SELECT label, release_signature FROM summary"))
def d7_cluster_signature(spark, sf):
    return _corpus_clusters(spark, sf)[4].select("label", "release_signature")


@register(
    "d8_stage_counts",
    _sqlr(
        CLUSTERS,
        "SELECT 'pages' AS stage, count(*) AS n FROM pages UNION ALL SELECT 'resolved', count(*) FROM resolved "
        "UNION ALL SELECT 'url_dedup', count(*) FROM d2 UNION ALL SELECT 'title_dedup', count(*) FROM d3 "
        "UNION ALL SELECT 'clusters', count(*) FROM summary UNION ALL SELECT 'multi_source_clusters', count(*) FROM summary WHERE source_count > 1 "
        "UNION ALL SELECT 'content_chars', sum(content_chars)::BIGINT FROM resolved",
    ),
)
def d8_stage_counts(spark, sf):
    """Stage totals as (stage, n) rows, each a global aggregate over a cut stage of one run."""
    pages = _pages(spark, sf)
    resolved = pages_as_resolved(pages).checkpoint()
    feats = page_features(url_dedup(resolved).withColumn("seq", F.col("first_seen"))).checkpoint()
    labels, _ = cluster_labels(feats, "components")
    sizes = labels.groupBy("run_id", "task_name", "label").agg(F.count(F.lit(1)).alias("source_count"))

    def count(df, stage):
        return df.agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit(stage).alias("stage"), "n")

    parts = [
        count(pages, "pages"),  # answered from the files' footers
        count(resolved, "resolved"),
        count(feats, "url_dedup"),
        count(dedupe_pages(resolved), "title_dedup"),
        count(sizes, "clusters"),
        count(sizes.filter(F.col("source_count") > 1), "multi_source_clusters"),
        resolved.agg(F.sum("content_chars").cast("long").alias("n")).select(F.lit("content_chars").alias("stage"), "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "t2_cluster_order",
    _sqlr(CLUSTERS, "SELECT label, cluster_id AS position FROM ordered"),
)
def t2_cluster_order(spark, sf):
    s = _corpus_clusters(spark, sf)[4]
    return C.rank(s, cap=None).select("label", F.col("cluster_id").alias("position"))


@register("t3_cap", _sqlr(CLUSTERS, "SELECT label FROM ranked"))
def t3_cap(spark, sf):
    return _corpus_clusters(spark, sf)[5].select("label")


@register("w2_cluster_id", _sqlr(CLUSTERS, "SELECT cluster_id, label, rep_title FROM ranked"))
def w2_cluster_id(spark, sf):
    return _corpus_clusters(spark, sf)[5].select("cluster_id", "label", F.col("rep.title").alias("rep_title"))


def _k1_sql():
    ts = O.lit(CFG.run_ts.replace(" ", "T"))
    return _sqlr(
        CLUSTERS,
        "SELECT r.task_name, r.cluster_id, (SELECT count(*) FROM ranked r2 WHERE r2.task_name = r.task_name) AS total_clusters, r.rep_title AS title, r.rep_url AS url, r.rep_domain AS domain, "
        "r.rep_status AS status, r.rep_chars::BIGINT AS content_chars, substring(r.rep_content, 1, 2000) AS content, "
        f"r.source_count, s.seq AS source_seq, s.title AS source_title, s.url AS source_url, s.domain AS source_domain, {ts} AS generated_at "
        "FROM ranked r JOIN srcs s ON s.run_id = r.run_id AND s.task_name = r.task_name AND s.cluster_id = r.cluster_id",
    )


@register("k1_json", _k1_sql())
def k1_json(spark, sf):
    feats, edges, labels, members, summary, ranked = _corpus_clusters(spark, sf)
    srcs = C.sources(members, ranked)
    return RP.json_rows(ranked, srcs, CFG.run_ts).drop("run_id")


def _k1_document_sql():
    ts = O.lit(CFG.run_ts)
    head = "to_json({'task_name': task_name, 'generated_at': " + ts + ", 'total_clusters': n})"
    cluster = (
        "to_json({'id': cluster_id, 'title': rep_title, 'url': rep_url, 'domain': rep_domain, 'status': rep_status, "
        f"'content_chars': rep_chars::BIGINT, 'content': substring(rep_content, 1, {K.JSON_CONTENT_CHARS}), 'source_count': source_count}})"
    )

    def left_open(doc, name):
        return f"regexp_replace({doc}::VARCHAR, '\\}}$', '') || ',\"{name}\":['"

    return _sqlr(
        CLUSTERS,
        f"SELECT task_name, 0::BIGINT AS cluster_id, 0::BIGINT AS part, 0::BIGINT AS seq, {left_open(head, 'clusters')} AS text "
        "FROM (SELECT task_name, count(*) AS n FROM ranked GROUP BY task_name) "
        f"UNION ALL SELECT task_name, cluster_id, 1, 0, CASE WHEN cluster_id > 1 THEN ',' ELSE '' END || {left_open(cluster, 'sources')} FROM ranked "
        "UNION ALL SELECT task_name, cluster_id, 2, seq, CASE WHEN seq > min(seq) OVER (PARTITION BY task_name, cluster_id) THEN ',' ELSE '' END "
        "|| to_json({'title': title, 'url': url, 'domain': domain})::VARCHAR FROM srcs "
        "UNION ALL SELECT task_name, cluster_id, 3, 0, ']}' FROM ranked "
        f"UNION ALL SELECT DISTINCT task_name, {RP.JSON_END}, 4, 0, ']}}' FROM ranked",
    )


@register("k1_document", _k1_document_sql())
def k1_document(spark, sf):
    feats, edges, labels, members, summary, ranked = _corpus_clusters(spark, sf)
    names = ranked.select("run_id", "task_name").distinct()
    return RP.json_blocks(ranked, C.sources(members, ranked), names, CFG.run_ts).drop("run_id")


def _k2_sql():
    preview = (
        f"(CASE WHEN length(r.rep_content) > {K.MARKDOWN_PREVIEW_CHARS} THEN substring(r.rep_content, 1, {K.MARKDOWN_PREVIEW_CHARS}) || "
        f"{O.lit(K.MD_ELLIPSIS)} ELSE r.rep_content END)"
    )
    e = "''"
    section = O.sql_lines(
        O.sql_fmt(K.MD_SECTION, i="r.cluster_id", title="r.rep_title"),
        e,
        O.sql_fmt(K.MD_URL, url="r.rep_url"),
        O.sql_fmt(K.MD_DOMAIN, domain="r.rep_domain"),
        O.sql_fmt(K.MD_STATUS, status="r.rep_status"),
        O.sql_fmt(K.MD_LENGTH, chars="r.rep_chars"),
        O.sql_fmt(K.MD_SOURCES, n="r.source_count"),
        e,
        O.lit(K.MD_PREVIEW),
        e,
        preview,
        e,
    )
    header = O.sql_lines(
        O.sql_fmt(K.MD_HEADER, task="task_name"), O.sql_fmt(K.MD_GENERATED, ts=O.lit(CFG.run_ts.replace(" ", "T"))), e
    )
    more = O.sql_lines(O.lit(K.MD_MORE), e)
    rule_multi = O.sql_lines(e, O.lit(K.MD_RULE), e)
    rule_single = O.sql_lines(O.lit(K.MD_RULE), e)
    source_line = O.sql_fmt(K.MD_SOURCE_LINE, title="s.title", url="s.url", domain="s.domain")
    return _sqlr(
        CLUSTERS,
        f"SELECT task_name, 0::BIGINT AS cluster_id, 0::BIGINT AS part, 0::BIGINT AS seq, {header} AS text "
        "FROM (SELECT DISTINCT task_name FROM ranked) "
        f"UNION ALL SELECT r.task_name, r.cluster_id, 0, 0, {section} FROM ranked r "
        f"UNION ALL SELECT r.task_name, r.cluster_id, 1, 0, {more} FROM ranked r WHERE r.source_count > 1 "
        f"UNION ALL SELECT r.task_name, r.cluster_id, 3, 0, CASE WHEN r.source_count > 1 THEN {rule_multi} ELSE {rule_single} END FROM ranked r "
        f"UNION ALL SELECT s.task_name, s.cluster_id, 2, s.seq, {source_line} FROM srcs s WHERE s.seq <> s.rep_seq",
    )


@register("k2_markdown", _k2_sql())
def k2_markdown(spark, sf):
    feats, edges, labels, members, summary, ranked = _corpus_clusters(spark, sf)
    srcs = C.sources(members, ranked)
    return RP.markdown_rows(ranked, srcs, CFG.run_ts).select("task_name", "cluster_id", "part", "seq", "text")


# ================================================================ C1 leader


@register("c1_leader", _sqlr(CORPUS + O.edge_ctes() + O.leader_ctes(), "SELECT seq, label FROM labels"))
def c1_leader(spark, sf):
    return leader_labels(_features(spark, sf).checkpoint()).select("seq", "label")


@register("c1_refined", _sqlr(CORPUS + O.edge_ctes() + O.leader_ctes("labels_0") + O.refine_ctes(), "SELECT seq, label FROM labels"))
def c1_refined(spark, sf):
    labels, _ = cluster_labels(_features(spark, sf).checkpoint(), "refined")
    return labels.select("seq", "label")


# ---- C1 in arrival order, over pages and documents as one corpus


def _united_ctes():
    columns = "run_id, task_name, {seq} AS seq, title, snippet, content, domain, domain_score, content_chars"
    docs = f"SELECT *, length(content) AS content_chars FROM (SELECT {O.lit(K.DEFAULT_RUN_ID)} AS run_id, {O.lit(CORPUS_TASK)} AS task_name, doc_id, "
    docs += f"{O.excerpt('text', DOC_TITLE_CHARS)} AS title, '' AS snippet, {O.ws('text')} AS content, '' AS domain, 0 AS domain_score FROM documents)"
    united = f"SELECT {columns.format(seq='first_seen')} FROM d2 UNION ALL SELECT {columns.format(seq=f'{DOC_SEQ} + doc_id')} FROM ({docs})"
    return O.pages_resolved_ctes() + O.dedup_ctes() + [f"dz AS ({united})"] + O.feature_ctes("dz")


def _united(spark, sf):
    """URL winners of the pages and, after them, the documents as pages of no host: title and text, no snippet."""
    pages = _features(spark, sf)
    text = X.normalize_ws("text")
    docs = tables.documents(spark, sf).select(
        F.lit(K.DEFAULT_RUN_ID).alias("run_id"),
        F.lit(CORPUS_TASK).alias("task_name"),
        (F.lit(DOC_SEQ) + F.col("doc_id")).alias("seq"),
        X.excerpt("text", DOC_TITLE_CHARS).alias("title"),
        F.lit("").alias("snippet"),
        text.alias("content"),
        F.lit("").alias("domain"),
        F.lit(0).alias("domain_score"),
        F.length(text).alias("content_chars"),
    )
    columns = ["run_id", "task_name", "seq", "tokens", "title_tokens", "version", "signature", "official_bonus", "domain_score", "content_chars"]
    return pages.select(*columns).unionByName(page_features(docs).select(*columns))


@register("c1_grown", _sqlr(_united_ctes() + O.arrival_ctes(), "SELECT seq, label FROM labels"))
def c1_grown(spark, sf):
    labels, _ = cluster_labels(_united(spark, sf).checkpoint(), "grown")
    return labels.select("seq", "label")


#: Successive excerpts of a page in c1_grown_excerpts: words of each, words from one to the next, how many.
EXCERPT_WORDS, EXCERPT_STEP, EXCERPTS = 40, 10, 4
#: Excerpts come one after the other: all first ones, then all second ones.
EXCERPT_SEQ = 1 << 20


def _excerpt_ctes():
    own = f"w[k * {EXCERPT_STEP} + 1:k * {EXCERPT_STEP} + {EXCERPT_WORDS}]"
    rows = (
        f"SELECT *, length(content) AS content_chars FROM (SELECT run_id, task_name, k * {EXCERPT_SEQ} + first_seen AS seq, array_to_string({own}[1:5], ' ') AS title, "
        f"'' AS snippet, array_to_string({own}, ' ') AS content, domain, domain_score FROM ew, range({EXCERPTS}) AS t(k) WHERE len(w) > k * {EXCERPT_STEP})"
    )
    return O.pages_resolved_ctes() + O.dedup_ctes() + [f"ew AS (SELECT *, string_split({O.ws('content')}, ' ') AS w FROM d2)", f"dz AS ({rows})"] + O.feature_ctes("dz")


def _excerpt_features(spark, sf):
    """The URL winners as successive excerpts, each of which shares most of its words with the one before it, and ever fewer with the first."""
    words = F.split(X.normalize_ws("content"), " ")
    part = lambda k: F.slice("w", k * EXCERPT_STEP + 1, EXCERPT_WORDS)
    rows = F.explode(F.transform(F.array(*[F.lit(k) for k in range(EXCERPTS)]), lambda k: F.struct(k.alias("k"), part(k).alias("own"), F.size("w").alias("n"))))
    d2 = url_dedup(_resolved(spark, sf)).withColumn("w", words).select("*", rows.alias("x")).filter(F.col("x.n") > F.col("x.k") * EXCERPT_STEP)
    shown = d2.withColumns(
        {
            "seq": F.col("x.k").cast("long") * EXCERPT_SEQ + F.col("first_seen"),
            "title": F.array_join(F.slice("x.own", 1, 5), " "),
            "snippet": F.lit(""),
            "content": F.array_join("x.own", " "),
        }
    )
    return page_features(shown.withColumn("content_chars", F.length("content")).drop("w", "x"))


@register("c1_grown_excerpts", _sqlr(_excerpt_ctes() + O.arrival_ctes(), "SELECT seq, label FROM labels"))
def c1_grown_excerpts(spark, sf):
    """Growth decides here: a later excerpt meets the union of those before it, not the first one."""
    labels, _ = cluster_labels(_excerpt_features(spark, sf).checkpoint(), "grown")
    return labels.select("seq", "label")


# ================================================================ Q1


def _q1_sql():
    ctes = HITS + O.resolve_ctes(CFG, "hits") + O.dedup_ctes("resolved") + O.feature_ctes() + O.arrival_ctes()
    ctes += O.cluster_ctes("final_event_cap")
    ctes = [c.replace("FROM summary)", "FROM (SELECT s.*, q.final_event_cap FROM summary s JOIN (SELECT DISTINCT task_name, final_event_cap FROM queries) q USING (task_name)))") if c.startswith("ordered AS") else c for c in ctes]
    return _sqlr(
        ctes,
        "SELECT task_name, cluster_id, rep_title AS title, rep_url AS url, rep_domain AS domain, rep_status AS status, "
        "rep_chars::BIGINT AS content_chars, source_count, release_signature, first_seen FROM ranked",
    )


@register("q1_triage", _q1_sql())
def q1_triage(spark, sf):
    return triage_report(run_triage(spark, _pages(spark, sf), CFG))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
