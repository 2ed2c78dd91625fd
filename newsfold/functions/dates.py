"""Publication dates of pages (inventory P5).

Pages name their date in a meta tag, in JSON-LD or in a ``time`` element, in
this order of trust.  The first value that is a date or an ISO 8601 time
counts, as an instant in UTC; a value without an offset is taken as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col as _c
from .common import let

#: Names of meta tags that hold a date of publication.
META_NAMES = (
    "article:published_time", "datepublished", "date", "pubdate", "publishdate",
    "publish-date", "dc.date", "dc.date.issued", "dcterms.created", "sailthru.date",
)
_NAMES = "|".join(n.replace(".", r"\.") for n in META_NAMES)
#: A tag may name its date before or after its value.
DATE_PATTERNS = (
    rf"""(?is)<meta\s[^>]*?(?:property|name|itemprop)\s*=\s*["'](?:{_NAMES})["'][^>]*?\scontent\s*=\s*["']([^"']*)["']""",
    rf"""(?is)<meta\s[^>]*?content\s*=\s*["']([^"']*)["'][^>]*?\s(?:property|name|itemprop)\s*=\s*["'](?:{_NAMES})["']""",
    r"""(?is)"datePublished"\s*:\s*"([^"]*)\"""",
    r"""(?is)<time\s(?:[^>]*?\s)?datetime\s*=\s*["']([^"']*)["']""",
)
#: Date, time, offset.
ISO_RE = r"^\s*(\d{4}-\d{2}-\d{2})(?:[Tt ](\d{2}:\d{2}(?::\d{2})?)(?:[.,]\d+)?\s*([Zz]|[+-]\d{2}:?\d{2})?)?\s*$"


def instant(value: Column) -> Column:
    """TIMESTAMP_NTZ in UTC of a date or ISO 8601 time, whole seconds; null for anything else."""

    def parsed(v: Column) -> Column:
        part = lambda k: F.regexp_extract(v, ISO_RE, k)
        time = F.when(part(2) == "", "00:00:00").when(F.length(part(2)) == 5, F.concat(part(2), F.lit(":00"))).otherwise(part(2))
        local = F.concat(part(1), F.lit(" "), time).try_cast("timestamp_ntz")
        offset = F.regexp_replace(part(3), "[Zz:]", "")
        minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 4, 2).try_cast("int")
        signed = F.when(offset == "", F.lit(0)).when(offset.startswith("-"), -minutes).otherwise(minutes)
        return F.when(v.rlike(ISO_RE), local - F.make_dt_interval(F.lit(0), F.lit(0), signed))

    return let(value, parsed)


def published_at(html) -> Column:
    """The first date that a page names, in the order of ``DATE_PATTERNS``; null where it names none."""
    found = [instant(F.regexp_extract(F.coalesce(_c(html), F.lit("")), p, 1)) for p in DATE_PATTERNS]
    return F.coalesce(*found)
