"""Main text of web pages: the maximum-scoring stretch of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import map_batches, text_of

# Tags of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe noembed noframes xmp".split())
DROPPED = frozenset(
    "head nav header footer aside form button select option menu dialog fieldset svg math canvas object audio "
    "video map label legend datalist".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "li main ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup td th time tt u var wbr".split()
)
TAGS = VOID | RAW | DROPPED | BLOCKS | INLINE | {"title"}
CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
CLUTTER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|adbox|adslot|banner|sponsor|sponsored|promo|"
    r"promotion|nav|navbar|navigation|menu|menubar|breadcrumb|breadcrumbs|pagination|pager|sidebar|side|aside|widget|"
    r"footer|foot|header|masthead|topbar|toolbar|cookie|cookies|consent|gdpr|notice|notices|notification|alert|popup|"
    r"modal|overlay|paywall|newsletter|subscribe|subscription|signup|signin|login|search|share|sharing|social|related|"
    r"recommended|recommendations|trending|comment|comments|commentlist|disqus|respond|reply|replies|discussion|"
    r"copyright|legal|disclaimer|skip|hidden)(?=$|[\s_-])"
)
HEAD_OF_PAGE = frozenset(("html", "body", "main", "article"))
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CONTENT = re.compile(r"<(?:article|main)[\s/>]", re.I)
END_OF_FORM = re.compile(r"</form\s*>", re.I)
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}

WORD, OPEN, CLOSE, NAME = "w", "o", "c", "n"
NAME_PART = re.compile(r"[a-z]{2,40}")
MAX_NAMES = 10_000
TASK_CLASSES = 100_000
LEARNT_CLUTTER, LISTED_WORD = -2.0, -1.0


def is_clutter(tag: str, attributes: str) -> bool:
    """Whether an element is no part of any article: by tag, role, or because it is hidden."""
    if tag in RAW or tag in DROPPED:
        return True
    if not attributes or tag in HEAD_OF_PAGE:
        return False
    for match in ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name == "role" and value in CLUTTER_ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def around_content(page: str, at: int) -> bool:
    """Whether the form whose tag ends here holds an article or main element: some pages stand in a
    form as a whole. Its controls are left out all the same."""
    end = END_OF_FORM.search(page, at)
    return CONTENT.search(page, at, end.start() if end else len(page)) is not None


def names_of(tag: str, attributes: str) -> tuple[frozenset[str], bool]:
    """The words of an element's class and id, and whether the list of clutter has one."""
    names, listed = frozenset(), False
    if attributes and tag not in HEAD_OF_PAGE:
        for match in ATTRIBUTE.finditer(attributes):
            if match[1].lower() in ("class", "id"):
                value = (match[2] or match[3] or match[4] or "").lower()
                names |= frozenset(NAME_PART.findall(value))
                listed = listed or CLUTTER.search(value) is not None
    return names, listed


def tokens_of(page: str) -> Iterator[tuple[str, str, str, bool, bool, frozenset[str], bool]]:
    """(kind, tag, text, clutter, content, names, listed) of each tag and stretch of text, in
    page order.

    ``tag`` is that of the tag itself or of the element around the text; ``content`` says
    that an article or main element is open. ``names`` are the class and id words of all open
    elements, ``listed`` says that the list of clutter has one, outside content. An unclosed element ends with an enclosing one
    or, for paragraphs and list items, with the next of its kind.
    """
    none: frozenset[str] = frozenset()
    stack: list[tuple] = []  # tag, clutter, content, names, listed

    def top() -> tuple:
        return stack[-1] if stack else ("", False, False, none, False)

    at = 0
    n = len(page)
    while at < n:
        match = TOKEN.search(page, at)
        start = match.start() if match else n
        if start > at:
            tag, clutter, content, names, listed = top()
            yield WORD, tag, page[at:start], clutter, content, names, listed
        if not match:
            return
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if not page.endswith(">", 0, at):
            return  # the page ends inside a tag
        if match[1]:
            yield CLOSE, tag, "", *top()[1:]
            if any(entry[0] == tag for entry in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        _, inside, content, names, listed = top()
        clutter = inside or is_clutter(tag, match[3])
        if tag == "form" and not inside and around_content(page, match.end()):
            clutter = False
        own, marked = names_of(tag, match[3])
        names = names | own if own else names
        content = content or tag in ("article", "main")
        listed = listed or marked and not content
        yield OPEN, tag, "", clutter, content, names, listed
        if tag in VOID or match[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW or tag == "title":
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append((tag, clutter, content, names, listed))


def token_class(kind: str, tag: str) -> str:
    return kind + (tag if tag in TAGS else "other" if tag else "")


def count_classes():
    """A function for ``mapInArrow``: how often each class of token lies in and out of content.

    Only pages that mark exactly one article (or else one main element) are labelled pages.
    Counts are passed on whenever there are many, which bounds a task's memory.
    """

    def told(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_pydict(
            {
                "class": pa.array(names, pa.string()),
                "outside": pa.array([counts[0][x] for x in names], pa.int64()),
                "inside": pa.array([counts[1][x] for x in names], pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for page in batch["larder_html"].to_pylist():
                low = page.lower()
                if low.count("<article") != 1 and low.count("<main") != 1:
                    continue
                for kind, tag, text, clutter, content, names, listed in tokens_of(page):
                    if clutter:
                        continue  # never scored by its class
                    many = len(text.split()) if kind == WORD else 1
                    if kind == WORD:
                        for name in names:
                            counts[content][NAME + name] += many
                    if not listed:
                        counts[content][token_class(kind, tag)] += many
                if len(counts[0]) + len(counts[1]) > TASK_CLASSES:
                    yield told(counts)
                    counts = (Counter(), Counter())
        yield told(counts)

    return run


def fit_weights(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """The weight of each class of token and each class or id word, from all labelled pages
    among ``pages``.

    Weights follow the log odds in and out of content: a word of text up to 2, a tag at most
    -0.02, neither with a floor; a class or id word weighs its log odds over the text in the
    elements that bear it. Tags and text that are never scored by their class (menus, scripts,
    hidden elements) or stand outside content under a listed name are not counted for tags.
    There are at most three classes per HTML tag, and the 10,000 names with the most text,
    which bounds what reaches the driver.
    """
    texts = pages.select(text_of(html_col).alias("larder_html"))
    counts = texts.mapInArrow(count_classes(), "class string, outside bigint, inside bigint").groupBy("class")
    counts = counts.agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    named = F.col("class").startswith(NAME)
    names = counts.where(named).orderBy(F.desc(F.col("outside") + F.col("inside")), "class").limit(MAX_NAMES)
    weights = {}
    for row in counts.where(~named).union(names).collect():
        odds = math.log((row["inside"] + 1) / (row["outside"] + 1))
        kind = row["class"][0]
        weights[row["class"]] = odds if kind == NAME else min(2.0, 1 + odds / 4) if kind == WORD else min(-0.02, odds - 1)
    return weights


def extract(page: str, weights: dict[str, float]) -> str:
    """The text of the best stretch of tokens, without what is marked as clutter in it.

    Under names that the labelled pages show outside content, text scores against the stretch
    and is left out; under names only the list has, outside an article or main element, it
    scores against the stretch, and stays if the best stretch goes on behind it.
    """
    tokens = []
    best = (0.0, 0, 0)
    score, start = 0.0, 0
    for i, (kind, tag, text, clutter, _, names, listed) in enumerate(tokens_of(page)):
        learnt = min((weights.get(NAME + name, 0.0) for name in names), default=0.0)
        out = clutter or learnt <= LEARNT_CLUTTER
        tokens.append((kind, tag, text, out))
        many = len(text.split()) if kind == WORD else 1
        if out or listed:
            score += -0.02 if kind != WORD else 0.0 if clutter else LISTED_WORD * many
        else:
            score += weights.get(token_class(kind, tag), 1.0 if kind == WORD else -0.2) * many
        if score <= 0:
            score, start = 0.0, i + 1
        elif score > best[0]:
            best = (score, start, i + 1)
    blocks: list[list[str]] = [[]]
    for kind, tag, text, out in tokens[best[1] : best[2]]:
        if kind == WORD:
            if not out:
                blocks[-1].append(html.unescape(text))
        elif tag in BLOCKS:
            blocks.append([])
        elif tag in ("br", "td", "th", "img", "wbr"):
            blocks[-1].append(" ")
    joined = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(block for block in joined if block)


def extract_pages(
    pages: DataFrame, weights: dict[str, float] | None = None, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page.

    Words score for and tags against a stretch of the page; the best stretch is found by one
    scan over the whole page. Menus, headers, footers, asides, forms, scripts, styles and
    hidden elements score nothing and are left out. Class and id words weigh what the
    labelled pages show; a fixed list stands in, outside articles, for those they don't show.
    Of equally good stretches the one that ends first counts, without a front that adds nothing.
    Weights are learnt from the pages themselves if none are given.
    Character references are decoded, white space in a block becomes one space, blocks are
    joined by an empty line. A null or empty page, or one without words, gives an empty
    text. Pages are treated one by one, repeated and very long ones too; an empty table gives
    an empty one, and only the named columns are read.
    """
    if weights is None:
        weights = fit_weights(pages, html_col)

    def make():
        def work(batch: pa.RecordBatch) -> list:
            texts = [extract(page, weights) for page in batch["larder_html"].to_pylist()]
            return [*[batch[name] for name in id_cols], texts, [len(text) for text in texts]]

        return work

    kinds = ", ".join(f"{name} {pages.schema[name].dataType.simpleString()}" for name in id_cols)
    rows = pages.select(*[column(name) for name in id_cols], text_of(html_col).alias("larder_html"))
    return map_batches(rows, f"{kinds}, text string, n_chars bigint", make)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
