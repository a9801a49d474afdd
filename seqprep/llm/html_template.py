"""Main text of web pages: a site's template is deduced from tokens that occur alike, the rest is extracted."""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqprep.operators.skew import join_skewed
from seqprep.sources.spool import spool

GROUP_PAGES = 64  # pages of a host that one template is deduced from, about
MIN_PAGES = 2  # different pages that a template takes
WORD_PAGES = 8  # different pages from which single words are tokens, fewer pages share whole blocks only
SUPPORT = 0.9  # of a group's different pages that a template token is on, all if they are few
SMALL_SHARE = 0.5  # of a typical page's text that the template of few pages may hold; beyond it they are near copies
LONG_BLOCK = 64  # words from which a block counts as one token
LINK_SHARE = 0.5  # of characters in links from which a part is a list of links
LINK_RUN = 3  # such blocks in a row on one path that make a list of links
MOST, MOST_WITH_ARTICLE = 0.8, 0.5  # of the text from which an element is kept whatever its name says
MARK_DEPTH = 32  # elements told by name that count apart when nested

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z:_-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z0-9]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea noscript iframe xmp noembed noframes title svg math template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_CLOSES = {name: frozenset(others.split()) for name, others in _CLOSES.items()}
_SCOPE = frozenset("article main section div ul ol dl table body td th blockquote".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# What is not the article: elements, roles, and words in class and id. The last words only describe a state.
_OTHER_ELEMENTS = frozenset("head nav footer aside button select input textarea dialog menu canvas".split())
_DOUBTFUL_ELEMENTS = frozenset("form label object".split())  # may as well wrap a whole page
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation "
    "menu sidebar masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login social share sharing related recommended recommendations widget "
    "comment comments reply replies respond disqus pagination pager toolbar copyright footer skip hidden".split()
)
_STATE_FIRST = frozenset("has no not is with without".split())
_STATE_LAST = frozenset("open closed enabled disabled allowed active on off left right".split())
_MAIN_WORDS = frozenset("article content post entry story".split())
_HEAD_ELEMENTS = frozenset("title meta link base style script noscript template".split())


@dataclass
class Block:
    path: int
    text: str
    mark: int  # innermost element that is not the article, -1 if none
    article: int  # outermost article element, -1 if none
    main: bool  # inside the main element
    story: bool  # inside a container named like an article
    links: int  # characters inside links


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    marks: list[tuple[int, bool]] = field(default_factory=list)  # enclosing mark, and whether it is beyond doubt
    depths: list[int] = field(default_factory=list)
    articles: int = 0
    tags: Counter = field(default_factory=Counter)  # how often a tag opens on each path

    def sure(self, block: Block) -> bool:
        """Whether a block lies in an element that cannot be the article."""
        return block.mark >= 0 and self.marks[block.mark][1]


@dataclass(frozen=True)
class Place:
    """Where the parser is: what the open elements say about text that comes now."""

    path: int = 0
    mark: int = -1
    article: int = -1
    main: bool = False
    story: bool = False
    link: bool = False


def parse(source: str) -> Page:
    """Blocks of a page in order, each with its path of open elements; broken markup is repaired as it comes."""
    page = Page()
    names: list[str] = []
    places: list[Place] = [Place()]
    parts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                here = places[-1]
                page.blocks.append(Block(here.path, text, here.mark, here.article, here.main, here.story, linked))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if places[-1].link:
                linked += len(text.strip())

    def close(found: int) -> None:
        del names[found:]
        del places[found + 1 :]

    while True:
        match = _MARKUP.search(source, at)
        add(source[at : match.start() if match else len(source)])
        if match is None:
            break
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:  # comment, declaration
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            for found in range(len(names) - 1, -1, -1):
                if names[found] == tag:
                    if tag in _INLINE and any(name not in _INLINE for name in names[found:]):
                        break
                    if any(name not in _INLINE for name in names[found:]):
                        flush()
                    close(found)
                    break
            continue
        if names and names[-1] == "head" and tag not in _HEAD_ELEMENTS:  # its end tag may be missing
            flush()
            close(len(names) - 1)
        if tag not in _INLINE:
            ended = _CLOSES.get(tag, _CLOSES["p"])
            for found in range(len(names) - 1, -1, -1):
                if names[found] in ended:
                    close(found)
                    break
                if names[found] in _SCOPE:
                    break
        if tag in _VOID or attributes.endswith("/") and tag not in _RAW:
            continue
        here = places[-1]
        sure, doubtful, main, story, label = _evidence(tag, attributes, here.article >= 0 or here.main or here.story)
        path = hash((here.path, tag, label))
        if tag not in _INLINE:
            page.tags[path] += 1
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        mark, article = here.mark, here.article
        if (sure or doubtful) and not (mark >= 0 and page.marks[mark][1]):
            depth = page.depths[mark] + 1 if mark >= 0 else 0
            if sure or depth < MARK_DEPTH:
                page.marks.append((mark, sure))
                page.depths.append(depth)
                mark = len(page.marks) - 1
        if tag == "article" and article < 0:
            article, page.articles = page.articles, page.articles + 1
        names.append(tag)
        places.append(Place(path, mark, article, here.main or main, here.story or story, here.link or tag == "a"))
    flush()
    return page


def _evidence(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool, bool, str]:
    """Whether an element is surely, or by its name, not the article; is main; is named so; its class and id words."""
    sure, doubtful, main = tag in _OTHER_ELEMENTS, tag in _DOUBTFUL_ELEMENTS or tag == "header" and not inside, tag == "main"
    if not attributes or attributes.isspace():
        return sure, doubtful, main, False, ""
    names: list[list[str]] = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            names += [_NAME.findall(part) for part in value.split()]
        elif name == "role":
            sure = sure or value in _OTHER_ROLES
            main = main or value == "main"
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDING.search(value):
            sure = True
    if tag in ("body", "html"):
        return False, False, main, False, ""
    words = {
        word
        for parts in names
        if parts and not (len(parts) > 1 and (parts[0] in _STATE_FIRST or parts[-1] in _STATE_LAST))
        for word in parts
    }
    story = False
    if words & _OTHER_WORDS or "header" in words and not inside:
        doubtful = doubtful or tag not in _HEADINGS
    else:
        story = tag in ("div", "section") and bool(words & _MAIN_WORDS)
    return sure, doubtful, main, story, " ".join(word for parts in names for word in parts)


def _tokens(block: Block) -> list[tuple[int, str]]:
    words = block.text.split(" ")
    return [(block.path, word) for word in words] if len(words) < LONG_BLOCK else [(block.path, block.text)]


def equivalence_classes(pages: list[list[tuple[int, str]]], support: float = SUPPORT) -> list[list[tuple[int, str]]]:
    """Tokens with equal occurrence vectors over the pages, as far as they form valid classes.

    A class holds at least two tokens that most pages have. It is valid if its tokens come in the same order on
    every page that has them and its stretch of each page lies inside, around or apart from those of larger
    classes.
    """
    counts = [Counter(page) for page in pages]
    spread = Counter(token for count in counts for token in count)
    vectors: dict[tuple[int, ...], list[tuple[int, str]]] = defaultdict(list)
    for token, number in spread.items():
        if number >= support * len(pages):
            vectors[tuple(count[token] for count in counts)].append(token)
    first = [dict(zip(reversed(page), range(len(page) - 1, -1, -1))) for page in pages]
    last = [dict(zip(page, range(len(page)))) for page in pages]
    valid: list[list[tuple[int, str]]] = []
    stretches: list[list[tuple[int, int]]] = []
    for vector, members in sorted(vectors.items(), key=lambda item: (-len(item[1]), item[0])):
        on = [number for number, count in enumerate(vector) if count]
        members.sort(key=first[on[0]].__getitem__)
        members = [m for p, m in enumerate(members) if all(_in_order(first[n], members, p) for n in on)]
        if len(members) < 2:
            continue
        stretch = {n: (min(first[n][m] for m in members), max(last[n][m] for m in members)) for n in on}
        if all(_nested(stretch[n], other[n]) for other in stretches for n in on if n in other):
            valid.append(members)
            stretches.append(stretch)
    return valid


def _in_order(places: dict, members: list, number: int) -> bool:
    here = places[members[number]]
    return (number == 0 or places[members[number - 1]] < here) and (
        number + 1 == len(members) or here < places[members[number + 1]]
    )


def _nested(one: tuple[int, int], two: tuple[int, int]) -> bool:
    apart = one[1] < two[0] or two[1] < one[0]
    return apart or one[0] <= two[0] and two[1] <= one[1] or two[0] <= one[0] and one[1] <= two[1]


def template_tokens(pages: list[Page]) -> set[tuple[int, str]]:
    """Tokens of the template that the pages share; pages with equal blocks count once.

    From ``WORD_PAGES`` different pages on tokens are words, which most pages have. Fewer pages are weaker
    evidence: tokens are whole blocks outside article elements that all of them have, every page must keep a
    block of its own, and a template that holds most of a typical page says that the pages are near copies.
    """
    different: dict[tuple, tuple[Page, list[Block]]] = {}
    for page in pages:
        blocks = [block for block in page.blocks if not page.sure(block)]
        different.setdefault(tuple((block.path, block.text) for block in blocks), (page, blocks))
    if len(different) < MIN_PAGES:
        return set()
    few = len(different) < WORD_PAGES
    sequences = []
    for page, blocks in different.values():
        tokens = [(path, "<") for path, number in page.tags.items() for _ in range(number)]
        for block in blocks:
            if not few:
                tokens += _tokens(block)
            elif block.article < 0:
                tokens.append((block.path, block.text))
        sequences.append(tokens)
    found = {token for members in equivalence_classes(sequences, 1.0 if few else SUPPORT) for token in members}
    if not few:
        return found
    shares = []
    for _, blocks in different.values():
        own = [len(block.text) for block in blocks if block.article >= 0 or (block.path, block.text) not in found]
        if not own:
            return set()
        shares.append(1 - sum(own) / sum(len(block.text) for block in blocks))
    if median(shares) > SMALL_SHARE:
        return set()
    # Blocks as such: a single word of a block is never a token here.
    return {(path, text) for path, text in found if text != "<"}


def _without_others(page: Page, blocks: list[Block]) -> list[Block]:
    """Blocks outside elements that are not the article; a name counts only if it leaves the text."""
    blocks = [block for block in blocks if not page.sure(block)]
    total = sum(len(block.text) for block in blocks)
    lifted: set[int] = set()
    while True:
        outermost: list[int] = []  # of each mark the outermost one around it that still counts
        for number, (around, _) in enumerate(page.marks):
            above = outermost[around] if around >= 0 else -1
            outermost.append(above if above >= 0 else -1 if number in lifted else number)
        left, sizes, links, articles = [], Counter(), Counter(), set()
        for block in blocks:
            mark = outermost[block.mark] if block.mark >= 0 else -1
            if mark < 0:
                left.append(block)
                continue
            sizes[mark] += len(block.text)
            links[mark] += block.links
            if block.article >= 0 or block.main:
                articles.add(mark)
        if not sizes or any(block.article >= 0 or block.main for block in left):
            return left
        largest = max(sizes, key=lambda mark: (sizes[mark], -mark))
        needed = MOST_WITH_ARTICLE if largest in articles else MOST
        if sizes[largest] <= needed * total or links[largest] > LINK_SHARE * sizes[largest]:
            return left
        lifted.add(largest)


def main_text(page: Page, template: set[tuple[int, str]]) -> str:
    """What remains of a page's slots: all articles, else the main part, else all but lists of links."""
    slots = [
        block
        for block in page.blocks
        if not (template and ((block.path, block.text) in template or all(t in template for t in _tokens(block))))
    ]
    kept = _without_others(page, slots)
    inside = [block for block in kept if block.article >= 0]
    if inside:
        sizes, links = Counter(), Counter()
        for block in inside:
            sizes[block.article] += len(block.text)
            links[block.article] += block.links
        prose = {article for article in sizes if links[article] <= LINK_SHARE * sizes[article]}
        kept = [block for block in inside if not prose or block.article in prose]
    elif any(block.main for block in kept):
        kept = [block for block in kept if block.main]
    else:
        kept = _without_link_lists(kept)
    return "\n".join(block.text for block in kept)


def _without_link_lists(blocks: list[Block]) -> list[Block]:
    kept: list[Block] = []
    run: list[Block] = []
    for block in [*blocks, None]:
        linked = block is not None and not block.story and block.links > LINK_SHARE * len(block.text)
        if run and not (linked and block.path == run[0].path):
            if len(run) < LINK_RUN:
                kept += run
            run = []
        if linked:
            run.append(block)
        elif block is not None:
            kept.append(block)
    return kept


def extract_main_text(pages: DataFrame, identity: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Pages meet by host; a host with more than about ``GROUP_PAGES`` pages is cut into groups by a hash, so no
    group grows with a host, and every page is in one. In each group tokens (tags on their path, words and long
    blocks on theirs; whole blocks alone if pages are few) with equal occurrence vectors form classes; valid
    classes are the template, blocks made of template tokens alone go. Of the remaining blocks those inside
    navigation, headers, footers, asides, forms, adverts, notices, comments, scripts and the like go too, unless
    only a name says so of what holds the article or most of the text. All articles (else the main part, else
    everything but lists of links) are the result. Copies of a page count once towards the template, so they do
    not make one of their text.

    Null, empty and text-free html gives an empty text; a missing or odd url is a host of its own; null ids
    stay null; repeated rows are answered each; broken and cut-off markup is read as far as it goes. An empty
    table gives an empty result; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    rows = pages.select(
        F.col(identity).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host.alias("host")
    )
    parts = rows.groupBy("host").agg(F.ceil(F.count("*") / GROUP_PAGES).alias("parts"))
    # One row per host, broadcast if counted as small; else pages of large hosts are salted. Either way pages are
    # dealt out by host and part, never by host alone.
    grouped = join_skewed(rows, spool(parts, "hosts"), ["host"])
    grouped = grouped.withColumn("part", F.pmod(F.xxhash64("page_id", "html"), F.col("parts")))
    grouped = grouped.select("page_id", "url", "html", "host", "part").repartition("host", "part")

    def extract(group: pa.Table) -> pa.Table:
        sources = [source or "" for source in group.column("html").to_pylist()]
        parsed = {source: parse(source) for source in set(sources)}
        template = template_tokens([parsed[source] for source in sorted(parsed)])
        found = {source: main_text(page, template) for source, page in parsed.items()}
        texts = pa.array([found[source] for source in sources], pa.string())
        return pa.table({"page_id": group.column("page_id"), "url": group.column("url"), "text": texts})

    kinds = dict(rows.dtypes)
    found = grouped.groupBy("host", "part").applyInArrow(
        extract, f"page_id {kinds['page_id']}, url string, text string"
    )
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
