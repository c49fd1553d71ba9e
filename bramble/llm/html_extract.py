"""Main text of web pages by site style trees.

Pages of one host are merged into a style tree. A node is a path of elements from the root
(tag and class words, digits folded). Two statistics tell how much it varies over the host's
pages: the child sequences of the element (presentation) and the texts that stand in it
(content), each as an entropy to the base of the number of observations, 0 where all are the
same and 1 where all differ. The importance of a node mixes its presentation with its
children's importance and content as in the published method:
(1 - DECAY^l) * presentation + DECAY^l * mean importance below, l the number of its
different child sequences; a leaf's importance is that of its content. A branch is the host's
template, and removed, where its node and all nodes below stay under ``low`` on at least
``min_pages`` pages while other texts of the host vary; a host full of copies keeps its text.

Besides, elements that say what they are go first: navigation, header, footer, aside, forms,
scripts, styles, and classes, ids or roles such as advert, menu, sidebar, notice or comments.
A layout word on a div or section, or a form that is the body's child, does not remove an
article or main element inside where the page has no other, nor its text where the page has
no article and no other text. Names that tell of a state, a topic or the page
(has-sidebar, no-ads, comments-open, category-cookies, sidebar-right-page,
content-sidebar-wrap) mark nothing, an article or main element is marked only by names made of
such words alone, and headings are not marked by names.
Where a page has an article (or main) element, its text is what is left in there, unless the
prose beside it (blocks of ``PROSE`` characters or more) is over ``BESIDE`` times as long: then
the article is a teaser, and the text is what stands beside it. Branches inside an article are
removed only under ``LOW_IN_ARTICLE``, and its headings only with a branch around them.

Text: character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined in page order by a line break. Unclosed and stray tags are tolerated, raw
elements end with their own end tag or the page.

The trees hold counts per (host, node, feature): they are summed in the task and by Spark
before anything meets, and only a host's template branches are joined back to its pages.
Null html gives an empty text; a null url is a host of its own kind; repeated rows are pages
like others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bramble.llm.shared import batches, write_shared

DECAY = 0.9
LOW = 0.15
LOW_IN_ARTICLE = 0.05
MIN_PAGES = 8
VARIED = 0.3
PROSE = 80
BESIDE = 4

# HTML's own element classes, and words by which pages mark what is not text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp
small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
            "tr": ("tr td th", "table thead tbody tfoot"), "td": ("td th", "tr"), "th": ("td th", "tr"),
            "thead": ("thead tbody tfoot tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"),
            "tfoot": ("thead tbody tfoot tr td th", "table")}
NOT_TEXT = frozenset("""aside audio button canvas dialog embed footer form head iframe input menu nav noembed noframes
noscript object script select style svg template textarea title video xmp""".split())
MARKS = frozenset("""ad adbox ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs captcha
comment commentlist comments consent cookie cookies copyright discussion disclaimer disqus footer gdpr header hidden login
masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended
recommendations related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription
toolbar topbar widget widgets""".split())
LAYOUT = frozenset("footer header menu nav navbar sidebar toolbar topbar widget widgets".split())
# words by which a name tells of a state, such as has-sidebar or comments-open, and of a wrapper
STATES = frozenset("closed has no open with without".split())
AFTER = frozenset("closed open".split())  # stand after the word that they are about
WRAPS = frozenset("container layout wrap wrapper".split())
PAGES = frozenset("body layout page site template".split())
SUBJECTS = frozenset("category format genre subject tag tags topic".split())
# marks that are also titles of sections, from which ids are made
TITLES = frozenset("copyright disclaimer discussion notice notices recommendations related".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an element's text: kept, kept where no other article is, dropped but for an article inside or
# where nothing else is (in a form around all, then under a layout word), dropped
KEPT, RESCUED, FORM, SOFT, HARD = range(5)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|([^\s=/>"']+)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SPACE = re.compile(r"\s+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c, bare in _ATTRIBUTE.findall(text):
        out.setdefault((name or bare).lower(), entities.unescape(a or b or c))
    return out


def named(tag: str, attrs: dict[str, str], in_article: bool) -> set[str]:
    """The marks among the words of the element's class and id."""
    found: set[str] = set()
    for attribute in ("class", "id"):
        for name in attrs.get(attribute, "").split():
            own = [w.lower() for w in _WORD.findall(name)]
            marks = [w for w in own if w in MARKS]
            if not marks or own[0] in SUBJECTS:
                continue
            if tag in ("article", "main"):
                # the words around a mark tell of the layout beside it or of a state
                found.update(marks if len(marks) == len(own) else ())
                continue
            if attribute == "id" and (in_article or tag == "section"):
                marks = [w for w in marks if w not in TITLES]
            if tag in ("div", "section"):
                if own[-1] in PAGES and len(own) > 1:
                    marks = [w for w in marks if w not in LAYOUT]
                if not STATES.isdisjoint(own) or own[:1] == ["content"] and own[-1] in WRAPS:
                    about = {a if b in AFTER else b for a, b in zip(own, own[1:]) if b in AFTER or (a in STATES and a not in AFTER)}
                    marks = [w for w in marks if w not in LAYOUT and w not in about and w not in ("comment", "comments")]
            found.update(marks)
    return found


def marked(tag: str, attrs: dict[str, str], in_article: bool, holder: str = "-") -> int:
    """Whether the element says that it isn't main text: HARD, or SOFT where a layout word of
    a div or section says so, or FORM right in the body; an article inside outweighs these."""
    if tag == "form" and holder in ("", "html", "body"):
        return FORM
    if tag in NOT_TEXT or (tag == "header" and not in_article):
        return HARD
    if not attrs or tag in ("html", "body"):
        return KEPT
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return HARD
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return HARD
    if tag in HEADINGS:
        return KEPT
    marks = named(tag, attrs, in_article)
    if tag in ("article", "main"):
        marks -= LAYOUT
    elif in_article:
        marks.discard("header")  # the head of the article itself
    return HARD if marks - LAYOUT or (marks and (in_article or tag not in ("div", "section"))) else SOFT if marks else KEPT


class Page:
    """Blocks of a page (path, text, in article) that no mark removes, and for every element
    left its path and child sequence."""

    def __init__(self, html: str):
        # blocks and child sequences by mark: under RESCUED those of articles that are used where
        # the page has no other, under FORM and SOFT those used where it has nothing else
        self.blocks_of: list[list[tuple[int, str, bool]]] = [[] for _ in range(HARD)]
        self.sequences_of: list[list[tuple[int, int]]] = [[] for _ in range(HARD)]
        self.parents: dict[int, int] = {0: 0}
        self.headings: set[int] = set()
        self.has_article = False
        # open elements: tag, path hash, mark, in article, hash of the children so far, the
        # nearest block (itself or around it)
        root: list = ["", 0, KEPT, False, 0]
        root.append(root)
        self.open: list[list] = [root]
        self.count: Counter = Counter()  # open elements by tag
        self.text: list[str] = []
        self.parse(html)
        while len(self.open) > 1:
            self.close()
        self.flush()
        used = [KEPT]
        if not any(article for _, _, article in self.blocks_of[KEPT]):
            used.append(RESCUED)
        if not self.has_article and not any(self.blocks_of[mark] for mark in used):
            used.append(FORM if self.blocks_of[FORM] else SOFT)
        self.blocks = [b for mark in used for b in self.blocks_of[mark]]
        self.sequences = [x for mark in used for x in self.sequences_of[mark]]

    def flush(self) -> None:
        if self.text:
            words = _SPACE.sub(" ", entities.unescape("".join(self.text))).strip()
            self.text = []
            if words:
                _, path, removed, article, *_ = self.holder
                self.blocks_of[removed].append((path, words, article))

    def close(self) -> None:
        tag, path, removed, _, children, _ = self.open[-1]
        if tag not in INLINE:
            self.flush()
            if removed < HARD:
                self.sequences_of[removed].append((path, children))
        self.count[tag] -= 1
        self.open.pop()

    def say(self, text: str) -> None:
        if text and self.open[-1][2] < HARD:
            if not self.text:
                self.holder = self.open[-1][5]
            self.text.append(text)

    def enter(self, tag: str, path: int, removed: int, article: bool, holder: list | None) -> None:
        element = [tag, path, removed, article, 0]
        element.append(element if holder is None else holder)
        self.open.append(element)
        self.count[tag] += 1

    def start(self, tag: str, raw: str) -> None:
        if tag in CLOSES_P:
            self.close_up_to("p", "button table td th")
        elif tag in SIBLINGS:
            for other in SIBLINGS[tag][0].split():
                self.close_up_to(other, SIBLINGS[tag][1])
        parent = self.open[-1]
        holder = parent[5]
        attrs = attributes(raw) if raw.strip(" /\n\t\r") else {}
        if tag in INLINE:
            if tag == "br":
                self.say(" ")
            if tag not in VOID:
                mark = marked(tag, attrs, parent[3])
                self.enter(tag, parent[1], max(parent[2], mark), parent[3], holder)
            return
        self.flush()
        look = " ".join([tag, *sorted({w.lower() for w in _WORD.findall(attrs.get("class", "")) if not w.isdigit()})])
        path = zlib.crc32(look.encode("utf-8", "replace"), holder[1]) | (zlib.adler32(look.encode("utf-8", "replace"), holder[1] & 0xFFFF) & 0x7FFF) << 32
        holder[4] = zlib.crc32(look.encode("utf-8", "replace"), holder[4])
        if tag in VOID:
            return
        mark = marked(tag, attrs, parent[3], holder[0])
        removed = max(parent[2], mark)
        article = parent[3] or tag in ("article", "main") or attrs.get("role", "").lower() == "main" or attrs.get("itemprop") == "articleBody"
        if article and removed in (FORM, SOFT) and mark == KEPT and not parent[3]:
            removed = RESCUED
        self.has_article |= article and removed <= RESCUED
        if tag in HEADINGS:
            self.headings.add(path)
        self.parents.setdefault(path, holder[1])
        self.enter(tag, path, removed, article, None)

    def close_up_to(self, tag: str, scope: str) -> None:
        """Close the nearest open ``tag`` and all inside it, unless an element of ``scope``
        stands between."""
        if not self.count[tag]:
            return
        stops = scope.split()
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == tag:
                while len(self.open) > i:
                    self.close()
                return
            if name in stops:
                return

    def parse(self, html: str) -> None:
        at, search = 0, _TAG.search
        while m := search(html, at):
            self.say(html[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if tag in INLINE:
                    self.close_up_to(tag, "p div td th li article section body")
                elif tag == "p" and not self.count["p"]:
                    self.flush()
                else:
                    self.close_up_to(tag, "")
                continue
            self.start(tag, m[3] or m[6] or "")
            if tag in RAW and self.open[-1][0] == tag:
                end = re.compile(f"</{re.escape(tag)}[\\s>/]", re.I).search(html, at)
                at = end.start() if end else len(html)
        self.say(html[at:])


def host(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def style_counts(pages: DataFrame, url_col: str, html_col: str, hold: int = 200_000) -> DataFrame:
    """(host, path, parent, kind, feature, article, n): the merged style trees. kind P has the
    child sequences of an element, kind C the texts in it."""
    names = ["host", "path", "parent", "kind", "feature", "article", "n"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]

    def out(counts: Counter) -> pa.RecordBatch:
        columns = list(zip(*(k for k in counts))) + [list(counts.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(it):
        counts: Counter = Counter()
        for b in batches(it):
            for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page, h = Page(html or ""), host(url)
                inside = {p for p, _, article in page.blocks if article}
                for path, children in page.sequences:
                    counts[h, path, page.parents[path], "P", children, path in inside] += 1
                for path, text, article in page.blocks:
                    data = text.encode("utf-8", "replace")
                    counts[h, path, page.parents[path], "C", zlib.crc32(data) | zlib.adler32(data) << 31, article] += 1
                if len(counts) >= hold:
                    yield out(counts)
                    counts = Counter()
        if counts:
            yield out(counts)

    made = pages.select(url_col, html_col).mapInArrow(
        run, "host string, path bigint, parent bigint, kind string, feature bigint, article boolean, n bigint")
    return made.groupBy("host", "path", "parent", "kind", "feature").agg(F.sum("n").alias("n"), F.max("article").alias("article"))


def _entropy() -> Column:
    """Entropy of the counts n, to the base of their sum: 1 for a single observation."""
    total = F.sum("n")
    spread = F.log(total) - F.sum(F.col("n") * F.log("n")) / total
    return F.when(total > 1, F.greatest(spread, F.lit(0.0)) / F.log(total)).otherwise(F.lit(1.0))


def importance(counts: DataFrame) -> DataFrame:
    """(host, path, parent, pages, importance, best, in_article) for every node; best is the
    greatest importance of the node and those below. A node's importance is linear in its
    children's, so values climb by doubled steps: links lead from a node to the one 2^k levels
    above, with its share in that one's importance, until no path is so deep."""
    nodes = counts.groupBy("host", "path", "kind").agg(
        F.min("parent").alias("parent"), F.sum("n").alias("pages"), F.count("*").alias("styles"), _entropy().alias("h"),
        F.max("article").alias("article"))
    by_path = write_shared(nodes.groupBy("host", "path").agg(
        F.min("parent").alias("parent"), F.max("pages").alias("pages"), F.max("article").alias("in_article"),
        F.max(F.when(F.col("kind") == "P", F.col("h"))).alias("presentation"),
        F.max(F.when(F.col("kind") == "P", F.col("styles"))).alias("styles"),
        F.max(F.when(F.col("kind") == "C", F.col("h"))).alias("content"),
        F.max(F.when(F.col("kind") == "C", F.col("pages"))).alias("texts")), "style-nodes")
    below = by_path.where("path <> parent").groupBy("host", F.col("parent").alias("path")).agg(F.sum("pages").alias("weight"))
    fade = F.pow(F.lit(DECAY), F.least("styles", F.lit(50)))
    whole = F.col("weight") + F.coalesce("texts", F.lit(0))
    alone = (1 - fade) * F.coalesce("presentation", F.lit(0.0)) + fade * F.coalesce(F.col("content") * F.col("texts"), F.lit(0.0)) / whole
    now = write_shared(by_path.join(below, ["host", "path"], "left").withColumn(
        "importance", F.when(F.col("weight").isNull(), F.coalesce("content", "presentation")).otherwise(alone)).withColumn(
        "passes", fade / whole), "style-nodes")
    links = write_shared(now.where("path <> parent").select("host", "path", F.col("parent").alias("up"), "pages").join(
        now.select("host", F.col("path").alias("up"), "passes"), ["host", "up"]).select(
        "host", "path", "up", (F.col("pages") * F.col("passes")).alias("share")), "style-links")
    steps = []
    # a path is shorter than the table; only paths that collide in their hashes go on for ever
    for _ in range(by_path.count().bit_length()):
        if links.isEmpty():
            break
        steps.append(links)
        add = now.join(links, ["host", "path"]).groupBy("host", F.col("up").alias("path")).agg(
            F.sum(F.col("importance") * F.col("share")).alias("add"))
        now = write_shared(now.join(add, ["host", "path"], "left").withColumn(
            "importance", F.col("importance") + F.coalesce("add", F.lit(0.0))).drop("add"), "style-nodes")
        above = links.selectExpr("host", "path as up", "up as top", "share as more")
        links = write_shared(links.join(above, ["host", "up"]).select(
            "host", "path", F.col("top").alias("up"), (F.col("share") * F.col("more")).alias("share")), "style-links")
    now = now.withColumn("best", F.col("importance"))
    for links in steps:
        add = now.join(links, ["host", "path"]).groupBy("host", F.col("up").alias("path")).agg(F.max("best").alias("add"))
        now = write_shared(now.join(add, ["host", "path"], "left").withColumn("best", F.greatest("best", "add")).drop("add"), "style-nodes")
    return now


def templates(nodes: DataFrame, min_pages: int, low: float) -> DataFrame:
    """(host, low_paths): the branches to remove of each host that has any."""
    varied = nodes.where("content is not null").groupBy("host").agg(F.max("importance").alias("most")).where(F.col("most") > VARIED)
    cut = nodes.join(varied, "host").where(
        (F.col("pages") >= min_pages) & (F.col("best") < F.when(F.col("in_article"), LOW_IN_ARTICLE).otherwise(low)))
    return cut.groupBy("host").agg(F.collect_set("path").alias("low_paths"))


def page_text(html: str | None, low: set[int]) -> str:
    page = Page(html or "")
    known: dict[int, bool] = {0: True}

    def stays(path: int) -> bool:
        climbed = []
        while path not in known and path not in low:
            climbed.append(path)
            path = page.parents[path]
        known.update(dict.fromkeys(climbed, known.get(path, False)))
        return known.get(path, False)

    # a heading of an article goes only with a branch around it
    blocks = [b for b in page.blocks if not low or stays(page.parents[b[0]] if b[2] and b[0] in page.headings else b[0])]
    inside, beside = ([b for b in blocks if b[2] == article] for article in (True, False))
    prose = sum(len(text) for _, text, _ in beside if len(text) >= PROSE)
    if prose > BESIDE * sum(len(text) for _, text, _ in inside):
        inside = beside
    return "\n".join(text for _, text, _ in inside or beside)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    cut = templates(importance(style_counts(rows, "url", "html")), min_pages, low)
    site = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(it):
        for b in batches(it):
            text = [page_text(h, set(p or ())) for h, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    joined = rows.withColumn("host", site).join(write_shared(cut, "style-templates"), "host", "left")
    return joined.select("page_id", "url", "html", "low_paths").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint")
