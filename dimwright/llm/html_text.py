"""Main text of web pages, with site templates removed.

Each page is read once, by a tolerant tag reader: unclosed and misnested tags are closed as browsers
do, roughly.  Elements that are never main text (menus, headers, footers, forms, scripts, ...;
by tag, role, class or id) are left out at once.  The main text is what the ``article`` elements hold, else
``main``, else the body.  Every container element is hashed with all it contains; Spark counts on how
many different pages of a host each hash occurs, and container subtrees that recur on at least
``MIN_PAGES`` pages are template and deleted; on more of a larger host, namely on ``MIN_SHARE`` of its pages, but
never more than ``MIN_PAGES`` times the binary logarithm of its pages.  Plain paragraphs
and headings of an article are never taken for template, and copies of one page count once.

Pages without any container in their main part (the usual article) are final after the first pass; the
hashes of the others are joined with those of their host's templates, in ``SALTS`` parts.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one
space.  Null and empty pages have empty text.  Pages without a host share the host ''.  Repeated
rows give repeated results.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from dimwright.llm.common import add_columns, save_table, table

#: a subtree is template from so many different pages and this share of the host's pages on
MIN_PAGES, MIN_SHARE = 3, 0.2
#: parts into which the pages that hold one template are dealt
SALTS = 32

# Fixed vocabulary of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template svg iframe textarea title math object"
STRUCTURAL = frozenset("html body main article section div nav header footer aside form table thead tbody tfoot ul ol dl "
                       "fieldset figure details dialog blockquote head".split())
BLOCKS = STRUCTURAL | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre hr br address figcaption caption summary center option "
                                "legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: start tag -> open tags of the same place that it closes
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
#: containers whose subtrees are hashed; outside the main part paragraphs and items too
CONTAINERS = frozenset("div section aside nav header footer form table ul ol dl figure details blockquote fieldset".split())
LOOSE = CONTAINERS | frozenset("p li h1 h2 h3 h4 h5 h6".split())

DROPPED = frozenset("head nav footer header aside form button select option input dialog menu fieldset label canvas audio video "
                    "map datalist".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                          "toolbar".split())
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
                          "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup paywall nav navbar "
                          "navigation menu breadcrumb breadcrumbs sidebar sidenav widget widgets related recommended recommendations "
                          "share sharing social comment comments commentlist disqus replies respond pagination pager login search "
                          "skip hidden footer masthead toolbar header".split())
#: names that in an article mark the part with its title
ARTICLE_NAMES = frozenset(("header",))
#: names that also stand on wrappers of the whole page ("with-sidebar"): an article or main inside counts all the same
WRAPPER_NAMES = frozenset("header footer nav navbar navigation menu sidebar sidenav banner masthead toolbar social share sharing search "
                          "login skip hidden".split())
KEEP, WEAK, NAMED, STRONG = 0, 1, 2, 3
#: never dropped for a class or id word
MAIN_PARTS = frozenset("html body main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?:[\s/][^>]*)?/>"
    rf"|<({'|'.join(RAW.split())})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^<>\"']*+(?:\"[^\"]*\"[^<>\"']*+|'[^']*'[^<>\"']*+)*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)"
    r"|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Frame:
    __slots__ = ("tag", "drop", "article", "main", "parts", "first", "head")

    def __init__(self, tag, drop, article, main, first, head):
        self.tag, self.drop, self.article, self.main, self.first, self.head = tag, drop, article, main, first, head
        self.parts = [tag]


def boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    """KEEP, WEAK (a name that wrappers carry too), NAMED (another name) or STRONG."""
    if tag in DROPPED:
        return STRONG
    found = KEEP
    if attributes and ("=" in attributes or "hidden" in attributes):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                names = DROPPED_NAMES.intersection(_NAME.findall(value))
                if in_article:
                    names -= ARTICLE_NAMES
                # an article inside an article (a comment, say) is a part like others
                if names and (tag not in MAIN_PARTS or tag == "article" and in_article):
                    found = max(found, NAMED if names - WRAPPER_NAMES else WEAK)
            elif name == "role" and value in DROPPED_ROLES:
                return STRONG
            elif (name == "hidden" or (name == "aria-hidden" and value == "true")
                  or (name == "style" and re.search(r"display\s*:\s*none", value))):
                return STRONG
    return found


class Page:
    """Blocks of a page in order: [text, article, main, hashes of the containers around it]; and all subtree hashes."""

    def __init__(self, html: str, lift: int = WEAK):
        """``lift``: how strong a wrapper's drop may be for an article inside to count all the same."""
        from xxhash import xxh3_64_intdigest

        self.digest = xxh3_64_intdigest
        self.blocks, self.buffer = [], []
        self.subtrees: set[int] = set()
        self.article = self.main = self.wrapped = False
        self.lift = lift
        root = Frame("", KEEP, False, False, 0, False)
        self.stack = [root]
        for m in _TOKEN.finditer(html):
            tag = m.group(3)
            if tag is None:
                text = m.group()
                if text[0] != "<" or text == "<":
                    self.text(text)
            elif m.group(2):
                self.end(tag.lower())
            else:
                self.start(tag.lower(), m.group(4))
        while len(self.stack) > 1:
            self.pop()
        self.flush()

    def text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        top = self.stack[-1]
        if not top.drop:
            self.buffer.append(text)
        top.parts.append(text.strip())

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer = []
            if text:
                top = self.stack[-1]
                self.blocks.append([text, top.article, top.main, []])

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag not in ("br", "hr"):
                self.close_implied(IMPLIED.get(tag, ()), "p" if tag not in ("li", "dt", "dd", "tr", "td", "th") else "")
        top = self.stack[-1]
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            top.parts.append(tag)
            return
        own, head = boilerplate(tag, attributes, top.article), top.head
        drop = max(top.drop, own)
        if tag in ("article", "main") and own == KEEP and top.drop <= (NAMED if tag == "main" else self.lift):
            drop = KEEP
        self.wrapped |= tag == "article" and drop == NAMED
        if tag == "header" and top.article and not top.drop:
            head = True
        if head and tag in HEADINGS:
            drop = KEEP
        frame = Frame(tag, drop, top.article or (tag == "article" and not drop), top.main or (tag == "main" and not drop),
                      len(self.blocks), head)
        self.article |= frame.article
        self.main |= frame.main
        self.stack.append(frame)

    def close_implied(self, tags, paragraph: str) -> None:
        """Close open elements of the same place: down to the outermost one before a structural element."""
        at = 0
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags or tag == paragraph:
                at = i
            elif tag in STRUCTURAL:
                break
        while at and len(self.stack) > at:
            self.pop()

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i].tag in STRUCTURAL and tag not in STRUCTURAL:
                return

    def pop(self) -> None:
        if self.stack[-1].tag in BLOCKS:
            self.flush()
        frame = self.stack.pop()
        h = self.digest("\x1f".join(frame.parts).encode("utf-8", "surrogatepass")) - (1 << 63)
        self.stack[-1].parts.append(str(h))
        kept = frame.article or (frame.main and not self.article)
        if frame.tag in (CONTAINERS if kept else LOOSE):
            self.subtrees.add(h)
            for b in self.blocks[frame.first:]:
                b[3].append(h)


def read_page(html: str | None, url: str | None):
    """(host, page hash, text if final, else blocks with their subtree hashes, all subtree hashes)."""
    m = _HOST.match(url or "")
    host = m.group(1).lower() if m else ""
    page = Page(html or "")
    if page.wrapped and not page.article:
        # an article only inside a wrapper with a dropped name: it counts unless there is more text outside
        other = Page(html, NAMED)
        if sum(len(b[0]) for b in other.blocks if b[1]) > sum(len(b[0]) for b in page.blocks if b[2] or not page.main):
            page = other
    place = 1 if page.article else 2 if page.main else 0
    blocks = [b for b in page.blocks if not place or b[place]]
    page_hash = page.digest("\x1f".join(b[0] for b in blocks).encode("utf-8", "surrogatepass")) - (1 << 63)
    if any(b[3] for b in blocks):
        return host, page_hash, None, [(b[0], b[3]) for b in blocks], sorted(page.subtrees)
    return host, page_hash, " ".join(b[0] for b in blocks), None, sorted(page.subtrees)


BLOCK_LIST = ArrayType(StructType([StructField("text", StringType()), StructField("inside", ArrayType(LongType()))]))
PARSED = [StructField("__host", StringType()), StructField("__page", LongType()), StructField("__text", StringType()),
          StructField("__blocks", BLOCK_LIST), StructField("__subtrees", ArrayType(LongType()))]


def main_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", keep: list[str] | None = None) -> DataFrame:
    """Append ``text`` and ``n_chars`` to the ``keep`` columns of ``pages`` (default: all but the html)."""
    keep = [c for c in (pages.columns if keep is None else keep) if c != html_col and c.lower() not in ("text", "n_chars")]
    parsed = save_table(add_columns(pages, [html_col, url_col], PARSED,
                                    lambda: lambda html, url: [read_page(h, u) for h, u in zip(html, url)], keep=keep)
                        .withColumn("__row", F.monotonically_increasing_id()), "pages")
    seen = parsed.select("__host", "__page", F.explode("__subtrees").alias("__subtree")).distinct()
    counts = seen.groupBy("__host", "__subtree").agg(F.count(F.lit(1)).alias("n"))
    hosts = parsed.groupBy("__host").agg(F.count_distinct("__page").alias("pages"))
    needed = F.least(F.col("pages") * MIN_SHARE, F.log2("pages") * MIN_PAGES)
    templates = counts.filter(F.col("n") >= MIN_PAGES).join(hosts, "__host").filter(F.col("n") >= needed).select(
        "__host", "__subtree", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    kept = [F.col(f"`{c}`") for c in keep]
    final = parsed.filter("__blocks is null").select(*kept, F.col("__text").alias("text"))
    open_ = parsed.filter("__blocks is not null")
    inside = open_.select("__row", "__host", F.explode(F.array_distinct(F.flatten("__blocks.inside"))).alias("__subtree"),
                          F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int").alias("__salt"))
    # a row per page: the templates of the host that it holds
    met = inside.join(templates, ["__host", "__subtree", "__salt"]).groupBy("__row").agg(F.collect_set("__subtree").alias("__templates"))
    open_ = open_.join(met, "__row", "left")
    none = F.array().cast("array<bigint>")
    left = F.filter("__blocks", lambda b: ~F.arrays_overlap(b["inside"], F.coalesce("__templates", none)))
    cleaned = open_.select(*kept, F.array_join(F.transform(left, lambda b: b["text"]), " ").alias("text"))
    return final.unionByName(cleaned).withColumn("n_chars", F.length("text").cast("long"))


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
