"""Field extraction from crawled HTML pages (I8).

The scraper walked listing pages element by element. Here the same work is a
scan over a pages table: every block matching a pattern is pulled out with
``regexp_extract_all`` and ``posexplode``d, then each field is a
``regexp_extract`` on the block; a missing field gives '' (text) or 0 (counter),
like the scraper's defaults. Pages are independent, so this is map-only and
scales with the number of pages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.functions.text import age_to_date


@dataclass(frozen=True)
class Layout:
    block: str                                            # regex; group 0 is one block
    texts: dict = field(default_factory=dict)             # name -> regex, group 1
    counters: dict = field(default_factory=dict)          # name -> regex, group 1 (digits)


# Class names of the deal listing's markup. One "mlist" element per deal with
# a store link and age span in the "r j-r" box, a "subtitle" title and, in "stat-count",
# "j-count" counters (comments, bookmarks, shares in that order; an empty one counts 0).
# A block reaches to the next deal, however deeply its elements are nested.
_COUNTER = r'(?s)class="stat-count"(?:.*?class="j-count"[^>]*>){%d}\s*([0-9]*)'
LISTING = Layout(
    block=r'(?s)<div class="mlist\b.*?(?=<div class="mlist\b|\z)',
    texts={"store": r'(?s)class="r j-r"[^>]*>.*?<a[^>]*>([^<]*)</a>',
           "discount": r'class="subtitle"[^>]*>([^<]*)<',
           "age_text": r'(?s)class="r j-r"[^>]*>.*?<span[^>]*>([^<]*)</span>'},
    counters={"comments_count": _COUNTER % 1, "bookmarks_count": _COUNTER % 2, "shares_count": _COUNTER % 3},
)

# Generic crawl: links with their target and anchor text.
LINKS = Layout(block=r'<a\s[^>]*>[^<]*</a>',
               texts={"href": r'href="([^"]*)"', "text": r'>([^<]*)</a>'})
HEADINGS = Layout(block=r'<h1[^>]*>[^<]*</h1>', texts={"text": r'>([^<]*)</h1>'})


def extract_blocks(pages: DataFrame, layout: Layout, id_col: str = "page_id", html_col: str = "html",
                   keep: list[str] | None = None) -> DataFrame:
    """One row per block: (id, pos, fields...). ``pos`` is the 0-based block order in the page."""
    blocks = pages.select(id_col, *(keep or []),
                          F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(layout.block), 0)).alias("pos", "block"))
    cols = [F.regexp_extract("block", p, 1).alias(n) for n, p in layout.texts.items()]
    cols += [F.coalesce(F.nullif(F.regexp_extract("block", p, 1), F.lit("")).try_cast("bigint"), F.lit(0)).alias(n)
             for n, p in layout.counters.items()]
    return blocks.select(id_col, *(keep or []), "pos", *cols)


# The characters that markup must escape, and their escapes.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]


def escaped(text) -> Column:
    """``text`` as it stands in markup; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for plain, mark in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return out


def unescaped(text) -> Column:
    """The text that a browser shows for ``escaped`` text."""
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def listing_page(posts: DataFrame, as_of) -> Column:
    """Listing markup of one post (a column of ``posts`` with a parsed date): the inverse of ``extract_deals``."""
    age = F.coalesce(F.concat(F.date_diff(F.lit(as_of).cast("date"), "posted_date").cast("string"), F.lit(" days ago")), F.lit("soon"))
    count = lambda c: F.concat(F.lit('<i class="j-count">'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("</i>"))
    return F.concat(
        F.lit('<html><body><div class="nav"><a href="/">home</a></div>\n<div class="mlist"><div class="box"><div class="r j-r">\n<a href="/store">'),
        escaped(F.col("store")), F.lit("</a> <span>"), age, F.lit('</span></div>\n<div class="subtitle">'), escaped(F.col("discount")),
        F.lit('</div></div><div class="stat-count"><div>'), *map(count, ("comments_count", "bookmarks_count", "shares_count")),
        F.lit("</div></div></div>\n</body></html>"))


def extract_deals(pages: DataFrame, brand_col: str = "brand", as_of=None,
                  id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Deal rows from listing pages in the posts shape; the age text becomes a date (F2)."""
    rows = extract_blocks(pages, LISTING, id_col, html_col, keep=[brand_col])
    as_of = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return rows.select(F.col(brand_col).alias("brand"), unescaped(F.col("store")).alias("store"), unescaped(F.col("discount")).alias("discount"),
                       F.date_format(age_to_date("age_text", as_of), "yyyy-MM-dd").alias("posted_date"),
                       "comments_count", "bookmarks_count", "shares_count")
