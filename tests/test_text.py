"""Text, language and scoring functions on literal rows (X*, L*, R*)."""

import pytest
from pyspark.sql import functions as F

from newsfold import constants as K
from newsfold.functions import scoring as R
from newsfold.functions import text as X


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col(F.col("v")).alias("o")).first()["o"]


def test_clean_text_replaces_inside_words(spark):
    got = one(spark, lambda c: X.clean_text(c, 4000), "please accept advertisement cookies and design update")
    assert got == "please accept cookies and de date"


def test_excerpt(spark):
    assert one(spark, X.excerpt, "a" * 318 + " bcd") == "a" * 318 + "..."
    assert one(spark, X.excerpt, "a" * 400) == "a" * 320 + "..."
    assert one(spark, X.excerpt, "  short   text ") == "short text"


@pytest.mark.parametrize(
    "title,key",
    [
        ("The New GPT-5.2 Is Here!", "the new gpt here"),
        ("人工智能 发布", "人工智能"),
        ("Étude complète", "tude compl"),
        ("Новая модель", ""),
        ("カタカナ", ""),
        ("", ""),
    ],
)
def test_title_key(spark, title, key):
    assert one(spark, X.title_key, title) == key


def test_tokens_signature_version(spark):
    t = "Introducing GPT-5.2: the new open-source agent"
    assert one(spark, X.tokens, t) == ["introducing", "gpt-5.2", "open-source"]
    df = spark.createDataFrame([(t, "", "")], "title string, snippet string, content string")
    r = df.select("title", X.page_version("title", "snippet", "content").alias("v")).withColumn(
        "s", X.release_signature(F.col("title"), F.col("v"))
    ).first()
    assert r["v"] == "5.2"
    assert r["s"] == "introducing gpt-5.2 open-source::5.2"


@pytest.mark.parametrize(
    "text,version",
    [("released v2.5.1 today", "v2.5.1"), ("x 1.2.3.4.5", "1.2.3.4"), ("gpt4.5 only", ""), ("模型2.5发布", "")],
)
def test_version(spark, text, version):
    assert one(spark, X.version_token, text) == version


def test_pure_version(spark):
    df = spark.createDataFrame([("v1.2",), ("1.2.3.4",), ("gpt-5.2",), ("1.2.3.4.5",)], "t string")
    got = [r[0] for r in df.select(X.is_pure_version("t")).collect()]
    assert got == [True, True, False, False]


@pytest.mark.parametrize(
    "text,region,lang",
    [
        ("東京でAI", "jp-jp", "zh"),
        ("カタカナ", "jp-jp", "ja"),
        ("AI 에이전트", "kr-kr", "ko"),
        ("AI模型", "cn-zh", "zh"),
        ("ИИ", "ru-ru", "ru"),
        ("München KI", "fr-fr", "en"),
        ("Japón", "es-es", "en"),
        ("não", "pt-pt", "en"),
        ("öl", "tr-tr", "en"),
        ("AI agent", "tr-tr", "en"),
        ("launch now", "us-en", "en"),
        ("ישראל", "wt-wt", "unknown"),
        ("वक", "in-en", "unknown"),
        ("", "us-en", "unknown"),
    ],
)
def test_region_and_language(spark, text, region, lang):
    assert one(spark, X.region, text) == region
    assert one(spark, X.language_hint, text) == lang


@pytest.mark.parametrize(
    "host,score,bonus",
    [
        ("github.com", 3, 4),
        ("docs.github.com", 5, 4),
        ("blog.google.com", 5, 4),
        ("news.google.com", 4, 4),
        ("devblogs.microsoft.com", 0, 4),
        ("arxiv.org", 2, 0),
        ("techcrunch.com", 1, 0),
        ("example.com", 0, 0),
    ],
)
def test_scores(spark, host, score, bonus):
    assert one(spark, R.domain_score, host) == score
    assert one(spark, R.official_bonus, host) == bonus


def test_whitespace(spark):
    assert one(spark, X.normalize_ws, "　 a  b\x1c c\n") == "a b c"
    assert one(spark, X.normalize_ws, None) == ""


def test_whitespace_is_every_character_of_the_fixed_class(spark):
    """The pattern that runs finds what K.WS finds, in every character of the plane; printable ASCII is ruled out first."""
    points = [i for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame([(chr(i),) for i in points], "v string")
    assert X.WS_RE.startswith("[[^!-~]&&")
    assert rows.filter(F.col("v").rlike(X.WS_RE) != F.col("v").rlike(K.WS)).count() == 0
    assert rows.filter(F.col("v").rlike(X.WS_RE)).count() > 20


def test_clean_text_looks_for_phrases_once(spark):
    """A phrase is found as the separate patterns find it, also where another one's removal makes it."""
    texts = ["plain text", "SIGN UP now", "Cookies Policy x", "cookie policy", "si sign up gn up", "a\u00a0Subscribe  now b", "\u017fign up", "", None]

    def plain(col):
        t = X.normalize_ws(col)
        for pattern in K.BOILERPLATE_PATTERNS:
            t = F.regexp_replace(t, "(?i)" + pattern, " ")
        return F.trim(F.substring(X.normalize_ws(t), 1, 4000))

    df = spark.createDataFrame([(x,) for x in texts], "v string")
    got = df.select(X.clean_text("v", 4000).alias("a"), plain(F.col("v")).alias("b"))
    assert [r.a for r in got.collect()] == [r.b for r in got.collect()]
    assert X.BOILERPLATE_RE in df.select(X.clean_text("v", 4000))._jdf.queryExecution().optimizedPlan().toString()


def test_character_references(spark):
    import html

    from newsfold.functions.html import decode_entities

    rows = [
        "don&#8217;t &eacute;t&eacute; &#x1F600; &amp;lt; &bogus; &amp &; a&b;c && &#0; &#xD800; &CounterClockwiseContourIntegral;",
        "plain",
        "&lt;b&gt; &NotEqualTilde; &nbsp;",
    ]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "h string").select(decode_entities("h")).collect()]
    expected = [html.unescape(x.replace("&amp &;", "KEEP")).replace("KEEP", "&amp &;") for x in rows]
    assert got == expected


def test_html_tags(spark):
    from newsfold.functions.html import html_text, html_title, strip_dropped_elements

    rows = {
        "<header-bar>x</header-bar><p>body</p><header>h</header>": "x body",
        "<p title='a>b' class=\"c>d\">text</p>": "text",
        "<p title=\"open>text</p>": "text",
        "<nav/ x>gone</nav><abbr>kept</abbr>": "kept",
        "<NAV class=a>gone</nav >kept": "kept",
    }
    df = spark.createDataFrame([(x,) for x in rows], "h string")
    assert [r[0] for r in df.select(html_text(strip_dropped_elements("h"))).collect()] == list(rows.values())
    titles = spark.createDataFrame([("<title-x>no</title-x><title lang=a>T &amp; U</title>",)], "h string")
    assert titles.select(html_title("h")).first()[0] == "T & U"
