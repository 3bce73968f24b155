"""Main text of web pages, from container paths that the pages of a host agree on."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.llm.tables import bound_batches, read
from subsmart.operators.spread import settle, sized

# Elements that end the current block of text and start another.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is not markup.
RAW = set("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
# A start of one of the elements ends an open one on the left, up to the bounds.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Elements, roles and words of class or id that are not the article.
OTHER_TAGS = set("nav aside footer form button select menu dialog search object audio video canvas".split())
OTHER_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
OTHER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie "
    "cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup "
    "login nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar side rail widget widgets "
    "related recommended recommendations footer foot copyright masthead topbar toolbar share sharing social comment "
    "comments commentlist disqus reply replies respond discussion hidden search skip".split()
)
ARTICLE_TAGS = {"article", "main"}
# Parts of running text: no paths of their own, so their text stands in the container around them.
INNER_TAGS = set(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure "
    "figcaption".split()
)
# Words of a class name that tell a state or an absence, not what the element is.
STATE_WORDS = set("no not has have with without is open opened closed on off enabled disabled".split())
# A class name of more characters or hyphens is a page's own title or category.
LONGEST_CLASS, MOST_HYPHENS = 24, 2
# Class and id words do not decide where less than this share of the text would be left.
LEAST_LEFT = 0.1
# Levels over which a score is passed on (halved at each), and that a path's text names.
LEVELS = 40
# A host's path counts if it has this share of the host's votes, so a host has at most 100.
LEAST_VOTES = 0.01
# The winner moves up to a container with so much more text beside it, as a share of the winner's.
MORE_DIRECT, MORE_BELOW = 0.1, 0.5
NEVER_OTHER = {"html", "body", "main"}

TAG = re.compile(
    r"<!--|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>"
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


@dataclass
class Node:
    tag: str
    path: int
    other: bool  # by element, role or state
    article: bool
    marks: tuple[int, ...]  # elements around and including this one with other words


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    path: int  # the innermost container
    other: bool
    marks: tuple[int, ...] = ()
    article: bool = False  # inside an element that names itself the article


class Page:
    """Blocks of text in order and the tree of container paths, numbered parents first.

    Number 0 stands for the page itself. Containers of one parent with the same generalised
    name are one path.
    """

    def __init__(self):
        self.blocks: list[Block] = []
        self.parents, self.names = [-1], [""]
        self._digests = [b""]
        self._numbers: dict[tuple[int, str], int] = {}

    def __iter__(self):
        return iter(self.blocks)

    def path(self, parent: int, name: str) -> int:
        number = self._numbers.get((parent, name))
        if number is None:
            number = self._numbers[parent, name] = len(self.names)
            self.parents.append(parent), self.names.append(name)
            self._digests.append(hashlib.md5(self._digests[parent] + name.encode()).digest())
        return number

    def kind(self, path: int) -> str:
        return self.names[path].partition(".")[0]

    def around(self, path: int) -> list[int]:
        """The containers around a path, the innermost first."""
        out = []
        while path > 0:
            path = self.parents[path]
            out.append(path)
        return out

    def text_of(self, path: int) -> str:
        """The path's names; of a very deep one the last, after a digest of the others."""
        names: list[str] = []
        while path > 0 and len(names) < LEVELS:
            names.append(self.names[path])
            path = self.parents[path]
        if path > 0:
            names.append(self._digests[path].hex())
        return ">".join(reversed(names))


def generalised(tag: str, attributes: dict[str, str]) -> str:
    """The element's name with its classes, numbers replaced and a page's own names left out."""
    if tag in ("html", "body"):
        return tag
    classes = {
        DIGITS.sub("#", x)
        for x in attributes.get("class", "").split()
        if len(x) <= LONGEST_CLASS and x.count("-") <= MOST_HYPHENS
    }
    return ".".join([tag, *sorted(classes)])


def _is_other(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in NEVER_OTHER:
        return False
    if tag in OTHER_TAGS or (tag == "header" and not in_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return attributes.get("role", "").lower() in OTHER_ROLES


def _named_other(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a class or the id names something beside the article."""
    if tag in NEVER_OTHER:
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        found = set(WORDS.findall(name))
        if found & STATE_WORDS:
            continue
        if found & OTHER_WORDS or ("header" in found and not in_article):
            return True
    return False


def _settle_marks(page: Page) -> None:
    """Decide which blocks are other by the names around them.

    Names are evidence, not proof: while they leave less than ``LEAST_LEFT`` of the text, the
    element with most of it is no longer taken for something other. A page whose article names
    itself keeps to it, however short it is.
    """
    worth = {}
    free = [b for b in page.blocks if not b.other]
    for block in free:
        for mark in block.marks:
            worth[mark] = worth.get(mark, 0) + _worth(block)
    total, lifted = sum(map(_worth, free)), set()
    left = lambda: sum(_worth(b) for b in free if lifted.issuperset(b.marks))
    # Every step lifts the largest, so this ends after few: the rest is below the bound.
    sure = any(b.article and not b.marks and _worth(b) for b in free)
    while total and not sure and left() < LEAST_LEFT * total:
        mark = max((m for m in worth if m not in lifted), key=lambda m: (worth[m], -m))
        lifted.add(mark)
    for block in free:
        block.other = not lifted.issuperset(block.marks)


def parse(page: str) -> Page:
    """The page's blocks of text in order, each with its containers.

    Tags nest as far as they close; an end without a start is passed over, and what is
    open at the end closes there. Work grows with the page, however deep it nests.
    """
    tree = Page()
    blocks = tree.blocks
    stack = [Node("", 0, False, False, ())]
    opened: Counter = Counter()
    parts: list[str] = []
    linked, links, at, marked = 0, 0, 0, 0

    def close(i: int) -> None:
        opened.subtract(node.tag for node in stack[i:])
        del stack[i:]

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1]
                blocks.append(Block(text, linked, top.path, top.other, top.marks, top.article))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text)

    while True:
        match = TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        if match[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        closing, name, rest = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not name:
            continue
        tag = name.lower()
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if closing:
            if tag in BLOCKS:
                end_block()
                if opened[tag] > 0:
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                    links = 0
            continue
        if tag in RAW and not rest.endswith("/"):
            if tag in BLOCKS:
                end_block()
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag not in BLOCKS:
            continue
        end_block()
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            i = len(stack) - 1
            while any(opened[x] > 0 for x in ends) and i > 0 and stack[i].tag not in bounds:
                if stack[i].tag in ends:
                    close(i)
                i -= 1
        if tag in EMPTY:
            continue
        attributes = {}
        if rest:
            for found in ATTRIBUTE.finditer(rest):
                value = found[2] or found[3] or found[4] or ""
                attributes.setdefault(found[1].lower(), html.unescape(value))
        top = stack[-1]
        article = top.article or tag in ARTICLE_TAGS
        other = top.other or _is_other(tag, attributes, top.article)
        marks = top.marks
        if not other and attributes and len(marks) < LEVELS and _named_other(tag, attributes, top.article):
            marked += 1
            marks = (*marks, marked)
        path = tree.path(top.path, generalised(tag, attributes)) if tag not in INNER_TAGS else top.path
        stack.append(Node(tag, path, other, article, marks))
        opened[tag] += 1
    end_block()
    _settle_marks(tree)
    return tree


def _worth(block: Block) -> float:
    """Characters outside links; nothing for a block that is mostly links."""
    return 0.0 if block.other or 2 * block.linked > len(block.text) else len(block.text) - block.linked


def _direct(page: Page) -> list[float]:
    """The worth of each path's own blocks."""
    out = [0.0] * len(page.names)
    for block in page.blocks:
        out[block.path] += _worth(block)
    return out


def container_scores(page: Page) -> dict[int, float]:
    """A score for each container path: its blocks' worth, halved with every level between.

    The page itself is a container if it has text beside others.
    """
    scores: dict[int, float] = {}
    for path, worth in enumerate(_direct(page)):
        for _ in range(LEVELS):
            if not worth or path < 0:
                break
            scores[path] = scores.get(path, 0.0) + worth
            path, worth = page.parents[path], worth / 2
    if not _page_counts(page):
        scores.pop(0, None)
    return scores


def _page_counts(page: Page) -> bool:
    return any(b.path for b in page.blocks) and any(_worth(b) and not b.path for b in page.blocks)


def best_container(page: Page, scores: dict[int, float] | None = None) -> int | None:
    """The path of the highest score, the last of equals, moved up to where the article's rest stands.

    It moves to the innermost article or main element around it; to a container with
    ``MORE_DIRECT`` of its worth directly in it; and to one below the body with
    ``MORE_BELOW`` of its worth in other containers.
    """
    scores = container_scores(page) if scores is None else scores
    best = max(scores, key=lambda p: (scores[p], p), default=None)
    if best is None:
        return None
    direct = _direct(page)
    total = list(direct)
    for path in range(len(total) - 1, 0, -1):
        total[page.parents[path]] += total[path]
    around = page.around(best)
    if page.kind(best) not in ARTICLE_TAGS:
        best = next((p for p in around if page.kind(p) in ARTICLE_TAGS), best)
    for path in page.around(best):
        if path == 0 and not _page_counts(page):
            break
        below = 0.0 if page.kind(path) in ("", "html", "body") else total[path] - total[best]
        if direct[path] >= MORE_DIRECT * total[best] or below >= MORE_BELOW * total[best]:
            best = path
    return best


def main_text(page: Page, winners: list[str]) -> str:
    """The blocks inside the first of ``winners`` that the page has, else inside its own best path."""
    path = None
    if winners:
        total = _direct(page)
        for number in range(len(total) - 1, 0, -1):
            total[page.parents[number]] += total[number]
        last = {w.rpartition(">")[2] for w in winners}
        own = {
            page.text_of(number): number
            for number in range(1, len(total))
            if total[number] and page.names[number] in last
        }
        if _page_counts(page):
            own[""] = 0
        path = next((own[w] for w in winners if w in own), None)
    if path is None:
        path = best_container(page)
    if path is None:  # no containers: text without markup
        return "\n\n".join(b.text for b in page.blocks if not b.other and not b.path)
    inside = [number == path for number in range(len(page.names))]
    for number in range(1, len(inside)):
        inside[number] = inside[number] or inside[page.parents[number]]
    return "\n\n".join(b.text for b in page.blocks if not b.other and inside[b.path])


def _votes(batches):
    """Each page's vote: its best path, by the path's share of all scores."""
    for batch in batches:
        hosts, paths, votes = [], [], []
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = parse(text or "")
            scores = container_scores(page)
            if scores:
                best = best_container(page, scores)
                hosts.append(host), paths.append(page.text_of(best))
                votes.append(scores.get(best, 0.0) / sum(scores.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes, pa.float64())],
            ["host", "path", "vote"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """``host`` and ``paths``: container paths that got votes, the strongest first.

    A path needs ``LEAST_VOTES`` of all votes of its host, so a host has a bounded list
    however many paths its pages have; a page without any of them has its own best path.
    Votes are added up where the pages lie before they move.
    """
    bound_batches(pages.sparkSession)
    rows = pages.select(host(), "html")
    votes = rows.mapInArrow(_votes, "host string, path string, vote double")
    by_path = settle(votes.groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("vote")))
    whole = by_path.groupBy(F.col("host").alias("_host")).agg(F.sum("vote").alias("_all"))
    return (
        by_path.join(sized(whole).frame, F.col("host") == F.col("_host"))
        .filter(F.col("vote") >= F.col("_all") * LEAST_VOTES)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("vote")).alias("order"), "path"))).alias("ranked"))
        .select("host", F.col("ranked.path").alias("paths"))
    )


def host():
    return F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host")


def _texts(columns: list[str]):
    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            texts = [
                main_text(parse(page or ""), paths or [])
                for page, paths in zip(column("html").to_pylist(), column("_paths").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*(column(name) for name in columns), pa.array(texts, pa.string())], [*columns, "text"]
            )

    return run


def extract(pages: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``pages`` with ``text``, the main text of ``html``.

    In a first pass every page scores its containers and votes for one path of generalised
    tags and classes; votes are counted by host. In a second pass the text is taken from
    the host's strongest path that the page has, or from its own best path if it has none.
    Inside the path, navigation, forms, adverts, notices, comments and the like stay out,
    unless that would leave next to nothing of a page.

    Null and empty pages have empty text. Pages without a usable url share the empty host.
    Repeated rows are pages of their own.
    """
    winners = sized(
        settle(host_paths(pages)).select(F.col("host").alias("_host"), F.col("paths").alias("_paths"))
    )
    pages = pages.drop("_host", "_paths")
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in pages.select(*columns).dtypes)
    rows = pages.withColumn("_own", host()).join(winners.frame, F.col("_own") == F.col("_host"), "left")
    needed = rows.select(*dict.fromkeys([*columns, "html", "_paths"]))
    return needed.mapInArrow(_texts(columns), f"{kinds}, text string")


def op3_html(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    found = extract(read(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))
