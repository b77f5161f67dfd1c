"""Main text of web pages by the paths a host's pages agree on.

Every page scores its containers: the share of its text, without menus, notices and
the like, below a container, by the generalised path of tags and classes that leads
there.  The shares are summed per host and path in Spark; a host's winning path is
the one that holds most of the text of most of its pages, the deeper and the more
telling its name the better.  Then pages are read again along their host's path; a page
that has nothing there goes by its own best path.

The path names the article, its outermost ``article``, post or story element if it has one.
All text of that element stays, whatever its share; so do headings, leads and paragraphs
beside it.  Other containers beside it go if it says so itself (``article`` and the like)
or if the pages of the host agree on it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.operators.sizing import durable, keyed_join, measured

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][\w:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_UNENDED = re.compile(r"<[a-zA-Z/!?]")  # a tag that the page does not end
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CONTAINERS = frozenset(
    "html body main article section div header footer nav aside form table tbody thead tr td th ul ol li dl"
    " blockquote figure fieldset details menu dialog button label".split()
)
_BREAKS = frozenset("p h1 h2 h3 h4 h5 h6 hr pre dt dd figcaption caption address center summary legend".split())
_INLINE_CONTAINERS = frozenset("td th button label".split())
_SKIPPED = frozenset("nav aside footer form menu dialog button label fieldset head".split())
_WHOLE = frozenset("html body main article".split())
# fixed values: parts of class names, ids and roles
_ASIDE = frozenset(
    "nav navbar navigation menu sidebar side footer header masthead ad ads advert adverts advertisement advertising"
    " sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice notices alert popup"
    " modal share sharing social related recommend recommended recommendations comment comments commentlist disqus"
    " respond reply replies breadcrumb breadcrumbs pagination pager subscribe newsletter signup login search widget"
    " toolbar contentinfo complementary skip".split()
)
_ARTICLE = frozenset("article post entry story hentry".split())
_BODY = _ARTICLE | frozenset("content main body text page".split())
_LEAD = frozenset(
    "intro lead lede standfirst dek deck summary abstract title subtitle headline heading byline kicker excerpt meta author date".split()
)
_UNLESS = frozenset("has with without no".split())  # "has-sidebar" says what is inside
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MAIN = re.compile(r"content|main|article|entry|post|story|text|page|wrap|container|body", re.I)
_AGREED = 3  # pages of a host that have to agree before others' containers go


def _names(rest: str, pattern: re.Pattern) -> list[str]:
    return " ".join("".join(m) for m in pattern.findall(rest)).split()


def _parts(name: str) -> list[str]:
    return [part.lower() for part in _PART.findall(name)]


def _is_aside(tag: str, rest: str, inside_article: bool) -> bool:
    """An aside word in any name wins, unless another name says that this is the article."""
    if tag in _WHOLE:
        return False
    if tag in _SKIPPED or (tag == "header" and not inside_article):
        return True
    found = False
    for name in _names(rest, _NAMES) if rest else ():
        parts = _parts(name)
        if parts == ["main"] or (len(parts) > 1 and _ARTICLE & set(parts) and _BODY.issuperset(parts)):
            return False
        if _UNLESS & set(parts):
            continue
        aside = _ASIDE & set(parts)
        if aside == {"header"} and (inside_article or _ARTICLE & set(parts)):
            continue  # the head of the article
        found = found or bool(aside)
    return found


def _step(tag: str, rest: str) -> str:
    """A tag with its classes, numbers left out, so that siblings look alike."""
    names = sorted({re.sub(r"\d+", "", n).lower() for n in _names(rest, _CLASS)} - {""}) if rest else []
    return ".".join([tag, *names[:3]])


def _pieces(page: str) -> Iterator[tuple[str, bool, str | None, bool]]:
    """(path, in a link, text, in a h1) of text outside asides; text None is a block boundary."""
    stack: list[tuple[str, str, bool]] = []  # tag, path, aside
    link = 0
    top = False
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not (stack and stack[-1][2]):
            yield (stack[-1][1] if stack else ""), link > 0, page[at : m.start()], top
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            link = max(0, link - 1) if m["end"] else 1
            continue
        if tag == "br":
            yield (stack[-1][1] if stack else ""), False, " ", top
            continue
        if tag in _BREAKS:
            link = 0
            top = tag == "h1" and not m["end"]
            yield "", False, None, False
            continue
        if tag not in _CONTAINERS:
            continue
        yield "", False, (" " if tag in _INLINE_CONTAINERS else None), False
        link = 0
        top = top and tag in _INLINE_CONTAINERS
        if m["end"]:
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if m["rest"].endswith("/"):
            continue
        if stack and tag in ("li", "tr", "td", "th") and stack[-1][0] in (tag, "td", "th") and tag != "li":
            while stack and (stack[-1][0] == tag or (tag == "tr" and stack[-1][0] in ("td", "th"))):
                stack.pop()
        elif stack and tag == "li" and stack[-1][0] == "li":
            stack.pop()
        path, aside = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        inside = any(s[0] in ("article", "main") for s in stack)
        aside = aside or _is_aside(tag, m["rest"], inside)
        stack.append((tag, f"{path}/{_step(tag, m['rest'])}", aside))
    if at < len(page) and not (stack and stack[-1][2]) and not _UNENDED.match(page, at):
        yield (stack[-1][1] if stack else ""), link > 0, page[at:], top


def _prefixes(path: str) -> list[str]:
    parts = path.split("/")[1:]
    return ["/" + "/".join(parts[:k]) for k in range(1, len(parts) + 1)]


def container_shares(page: str) -> dict[str, float]:
    """Share of a page's text outside links below each container path."""
    own: Counter[str] = Counter()
    for path, link, text, _ in _pieces(page):
        if text and not link:
            own[path] += len(text.strip())
    total = sum(own.values())
    shares: Counter[str] = Counter()
    if total:
        for path, n in own.items():
            for prefix in _prefixes(path):
                shares[prefix] += n / total
    return dict(shares)


def path_bonus(path: str) -> float:
    last = path.rsplit("/", 1)[-1]
    tag, _, names = last.partition(".")
    telling = tag in ("article", "main") or bool(tag in ("div", "section", "td") and names and _MAIN.search(names))
    return min(path.count("/"), 10) * 0.01 + (0.2 if telling else 0.0)


def _best(shares: dict[str, float]) -> str:
    return max(shares, key=lambda p: (shares[p] + path_bonus(p), p), default="")


def _step_names(step: str) -> tuple[str, set[str]]:
    tag, _, names = step.partition(".")
    return tag, {part for name in names.split(".") for part in _parts(name)}


def _article(wanted: str) -> tuple[str, bool]:
    """The path of the whole article that the wanted path leads into, and whether it says so."""
    steps = [_step_names(step) for step in wanted.split("/")[1:]]
    prefixes = _prefixes(wanted)
    for says in (
        lambda tag, names: tag == "article",
        lambda tag, names: bool(names & _ARTICLE) and tag != "body",
        lambda tag, names: tag == "main",
    ):
        for prefix, step in zip(prefixes, steps, strict=True):
            if says(*step):
                return prefix, True
    return wanted, False


def _beside(path: str, article: str) -> str | None:
    """The first step of ``path`` that does not lead to the article, or none."""
    for own, other in zip(path.split("/")[1:], article.split("/")[1:], strict=False):
        if own != other:
            return own
    return None


def _is_article_part(step: str) -> bool:
    tag, names = _step_names(step)
    return tag == "header" or bool(names & _LEAD)


def main_text(page: str, wanted: str | None, agreed: bool = False) -> str:
    """The article at the wanted path, or at the page's own best.

    ``agreed`` says that other pages of the host have their article there too.
    """
    if not page:
        return ""
    pieces = list(_pieces(page))

    def below(path: str, top: str) -> bool:
        return path == top or path.startswith(top + "/") or not top

    if not wanted or not any(t and t.strip() and below(p, wanted) for p, _, t, _ in pieces):
        wanted, agreed = _best(container_shares(page)), False
    article, named = _article(wanted)
    titled = any(h1 and t.strip() for p, _, t, h1 in pieces if t and below(p, article))

    def stays(path: str, link: bool, h1: bool) -> bool:
        if not path or below(path, article) or (h1 and not link and not titled):
            return True
        step = _beside(path, article)
        if step is None:  # directly in an element around the article
            return not named
        return _is_article_part(step) or not (named or agreed)

    blocks, block = [], []
    for path, link, text, h1 in pieces:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif stays(path, link, h1):
            block.append(text)
    blocks.append("".join(block))
    clean = (" ".join(html.unescape(b).split()) for b in blocks if b.strip())
    return "\n".join(b for b in clean if b)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: Counter[tuple[str, str]] = Counter()
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if page.is_valid:
                for path, share in container_shares(page.as_py()).items():
                    votes[host, path] += share
                    if len(votes) > 100_000:
                        yield _vote_batch(votes)
                        votes.clear()
        if votes:
            yield _vote_batch(votes)


def _vote_batch(votes: Counter) -> pa.RecordBatch:
    hosts, paths = zip(*votes, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes.values(), pa.float64()),
         pa.array([path_bonus(p) for p in paths], pa.float64())],
        ["host", "path", "share", "bonus"],
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            some = batch.slice(at, 200)
            led = zip(*(some.column(c).to_pylist() for c in ("html", "path", "agreed")), strict=True)
            texts = [main_text(page or "", path, bool(agreed)) for page, path, agreed in led]
            yield pa.RecordBatch.from_arrays(
                [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), some.column("path")],
                ["page_id", "url", "text", "n_chars", "path"],
            )


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, path) of every row of ``pages``.

    ``path`` is the winning path of the page's host, null if it has none; of paths that
    score alike the last in order wins.  A null or empty html, and one without text outside
    asides, gives an empty text; an empty table gives no rows.  Pages are read whole, however
    long.  Pages whose url is null or has no host vote together.  Repeated rows and rows
    without id are extracted each for itself.  Other columns are not read, whatever their names.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")),
                                    r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    columns = pages.select(
        host.alias("host"),
        F.col(html_col).cast("string").alias("html"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
    )
    votes = columns.select("host", "html").mapInArrow(
        _votes, "host string, path string, share double, bonus double"
    )
    # every page's outermost path has all of its text, so the largest sum counts a host's pages
    summed = durable(
        votes.groupBy("host", "path").agg(
            F.sum("share").alias("share"), F.max("bonus").alias("bonus")
        )
    )
    pages_of = summed.groupBy("host").agg(F.max("share").alias("most"))
    score = F.round(F.col("share") / F.col("most") + F.col("bonus"), 9)
    winners = (
        summed.join(pages_of, "host")
        .groupBy(F.col("host").alias("_value"))
        .agg(
            F.max(F.struct(score.alias("score"), "path"))["path"].alias("path"),
            (F.max("most") > F.lit(_AGREED - 0.5)).alias("agreed"),
        )
    )
    led = keyed_join(columns, F.col("host"), measured(winners), "left")
    return led.select("page_id", "url", "html", "path", "agreed").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long, path string"
    )
