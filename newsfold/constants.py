"""Constants of the triage dataflow.

The block marked FIXED VALUES holds values that must equal the original tool's
for identical results (word lists, host lists, patterns, caps).  They are written
plainly, in their natural order.  Everything below that block is our own
(regular-expression spellings accepted by both Java regex and RE2, so that Spark
and the DuckDB oracle agree).
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the original tool's)
# --------------------------------------------------------------------------

# query-string keys dropped during URL canonicalisation (compared lowercased)
TRACKING_PARAMS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "ref",
    "ref_src",
    "source",
    "src",
)

# URL schemes whose canonical form is the empty string
BLOCKED_SCHEMES = ("javascript", "mailto")

# tokens never kept by the tokenizer
STOPWORDS = (
    "the", "and", "for", "with", "from", "that", "this", "into", "about",
    "inside", "guide", "news", "what", "when", "your", "their", "more", "have",
    "will", "has", "its", "new", "released", "release", "launch", "launched",
    "update", "framework", "platform", "agent", "agents", "agentic", "system",
    "tool", "tools",
)

# boilerplate phrases removed from page text, in this order, case-insensitive,
# without word boundaries
BOILERPLATE_PATTERNS = (
    r"cookie(s)? policy",
    r"subscribe now",
    r"sign up",
    r"all rights reserved",
    r"advertisement",
    r"accept cookies",
)

# title tokens skipped when building a release signature
SIGNATURE_SKIP_TOKENS = ("open", "source", "python", "github")

# search-engine redirect wrapper: host marker and the query keys tried in order
REDIRECT_HOST_MARKER = "duckduckgo.com"
REDIRECT_KEYS = ("uddg", "u3", "rut", "u")

# domain score: (host substrings, points); each group counts once
DOMAIN_RULES = (
    (("github.com", "openai.com", "anthropic.com", "google.com"), 3),
    (("arxiv.org", "docs.", "blog."), 2),
    (("news", "techcrunch", "venturebeat", "theverge"), 1),
)

# representative election: bonus when the host contains any of these
OFFICIAL_HOSTS = (
    "github.com",
    "openai.com",
    "anthropic.com",
    "google.com",
    "microsoft.com",
    "techcommunity.microsoft.com",
    "devblogs.microsoft.com",
)
OFFICIAL_BONUS = 4

# merge-rule thresholds as integer percentages (M2, M3 title, M4 title, M4 tokens)
TOKEN_OVERLAP_PCT = 72
VERSION_TITLE_OVERLAP_PCT = 50
TITLE_OVERLAP_PCT = 75
TITLE_TOKEN_OVERLAP_PCT = 45

# text windows and caps
TOKEN_CONTENT_CHARS = 800       # content prefix used for the page token set
VERSION_CONTENT_CHARS = 400     # content prefix searched for a version
EXCERPT_CHARS = 320             # source excerpt length
TITLE_KEY_TOKENS = 12           # tokens kept in a title key
SIGNATURE_TOKENS = 4            # title tokens kept in a release signature
JSON_CONTENT_CHARS = 2000       # content cut in the JSON report
MARKDOWN_PREVIEW_CHARS = 500    # content preview in the Markdown report

# command-line defaults when a task omits a flag
DEFAULT_TOP_K = 10
DEFAULT_EVENT_CAP = 12
DEFAULT_MAX_CONTENT_CHARS = 4000

# search-region cascade: first matching class wins, default us-en.  The four
# Latin classes are the case-insensitive originals: their members in their
# order, then the other case of each, since Java and RE2 do not ignore case
# alike (the Turkish one also matches plain i/I, as the original does).
REGION_RULES = (
    (r"[\x{3040}-\x{30ff}]", "jp-jp"),
    (r"[\x{ac00}-\x{d7af}]", "kr-kr"),
    (r"[\x{4e00}-\x{9fff}]", "cn-zh"),
    (r"[\x{0400}-\x{04ff}]", "ru-ru"),
    (r"[àâçéèêëîïôûùüÿñæœÀÂÇÉÈÊËÎÏÔÛÙÜŸÑÆŒ]", "fr-fr"),
    (r"[áéíñóúü¡¿ÁÉÍÑÓÚÜ]", "es-es"),
    (r"[ãõáâàçéêíóôõúÃÕÁÂÀÇÉÊÍÓÔÚ]", "pt-pt"),
    (r"[ğüşöçıİĞÜŞÖÇIi]", "tr-tr"),
    (r"[\x{0590}-\x{05ff}]", "wt-wt"),
    (r"[\x{0600}-\x{06ff}]", "wt-wt"),
    (r"[\x{0900}-\x{097f}]", "in-en"),
    (r"[\x{0b80}-\x{0bff}]", "in-en"),
)
DEFAULT_REGION = "us-en"

# language hint cascade (ideographs before kana), default unknown
LANGUAGE_RULES = (
    (r"[\x{4e00}-\x{9fff}]", "zh"),
    (r"[\x{3040}-\x{30ff}]", "ja"),
    (r"[\x{ac00}-\x{d7af}]", "ko"),
    (r"[\x{0400}-\x{04ff}]", "ru"),
    (r"[A-Za-z]", "en"),
)
DEFAULT_LANGUAGE = "unknown"

# fetch statuses
STATUS_OK = "ok"
STATUS_EMPTY = "empty_content"
STATUS_FALLBACK_PREFIX = "fallback:"

# search-reply text: section marker, title line, URL line, snippet opener
REPLY_SECTION_MARKER = "Search Results"
REPLY_TITLE_LINE = r"\d+\.\s+\*+(.+?)\*+"
REPLY_URL_LINE = r"\s+URL:\s+(.+)"
REPLY_SNIPPET_OPENER = "("

# Markdown report lines (joined by newlines)
MD_HEADER = "# Daily Report: {task}"
MD_GENERATED = "Generated: {ts}"
MD_SECTION = "## {i}. {title}"
MD_URL = "- **URL**: {url}"
MD_DOMAIN = "- **Domain**: {domain}"
MD_STATUS = "- **Status**: {status}"
MD_LENGTH = "- **Content Length**: {chars} chars"
MD_SOURCES = "- **Sources**: {n}"
MD_PREVIEW = "### Content Preview"
MD_MORE = "### Additional Sources"
MD_SOURCE_LINE = "- [{title}]({url}) ({domain})"
MD_RULE = "---"
MD_ELLIPSIS = "..."

# --------------------------------------------------------------------------
# Our own constants (regex spellings valid in Java regex and RE2)
# --------------------------------------------------------------------------

# Unicode whitespace as Python's str regex understands it
WS = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
# characters kept by the title key and by the tokenizer
TITLE_KEY_DROP = r"[^a-z0-9\x{4e00}-\x{9fff} ]"
TOKEN_DROP = r"[^a-z0-9\x{4e00}-\x{9fff}.+-]"
# first version-like token, group 1 (Unicode word boundaries spelled out)
VERSION_RE = (
    r"(?:^|[^\p{L}\p{N}_])(v?(?:\p{Nd}+\.){1,3}\p{Nd}+)(?:\z|[^\p{L}\p{N}_])"
)
PURE_VERSION_RE = r"^v?(?:\p{Nd}+\.){1,3}\p{Nd}+\z"
# RFC 3986 appendix B
URL_RE = r"(?s)^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SCHEME_OK_RE = r"^[A-Za-z][A-Za-z0-9+.-]*$"
BRACKET_HOST_OK_RE = r"^(?:[^@\[\]]*@)?\[[0-9A-Fa-f:.]+\](?::[^\[\]]*)?$"
# path ; params split (params follow the first ';' after the last '/')
PATH_PARAMS_RE = r"(?s)^(.*?)(?:;([^/]*))?$"
# a '%' that does not start a valid escape
BAD_PERCENT_RE = r"%(?![0-9A-Fa-f]{2})"

# urllib's scheme families (Python standard library values)
USES_NETLOC = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
    "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
    "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
)
USES_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
    "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

# HTML elements dropped with their content by the text extractor
DROPPED_ELEMENTS = ("script", "style", "noscript", "svg", "header", "footer", "nav")
# a character reference at the start of a piece cut before its '&': group 1 is
# a decimal, hexadecimal or named reference
ENTITY_RE = r"^&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# elements without content: they never stay open
VOID_ELEMENTS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
)
# elements whose text is one block for main-content scoring
BLOCK_ELEMENTS = (
    "p", "div", "article", "section", "main", "aside", "h1", "h2", "h3", "h4",
    "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "blockquote",
    "pre", "form", "figure", "figcaption", "dd", "dt", "dl",
)
MAIN_MIN_WORDS = 10             # the main content has at least this many words outside links

# fixed instant of a run (reports never use the wall clock in tested output)
DEFAULT_RUN_TS = "2024-02-15T00:00:00+00:00"
DEFAULT_RUN_ID = "run_2024_02_15_000000"
