"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score above zero, tags below, and the contiguous stretch with the
largest sum, found in one linear scan, is the content region. The scores are log odds of lying inside the content,
counted on labelled pages, of which at most `LABELLED` are used: pages with their known text.

Words inside elements that are boilerplate by their name, role, class or id (menus, page headers, footers, sidebars,
notices, adverts, forms, reader comments) or that aren't shown score nothing and are left out of the region's text. A class,
an id, a form and a part that begins with a heading like "Comments" are weighed against the words inside: an element that holds most words of its <article> or <main>, or, outside of them, most of
theirs (of the page's if there are none), and not mainly links, is content whatever it is called. The region is then
extended to the whole of every <article> or <main> that directly holds one of its words: what the author marked is not
cut short at a list of links, and nothing the scan chose is dropped.

Character references are decoded. White space inside a block becomes one space, blocks are joined by a line feed.

Edge cases: null or empty html, and pages without words outside boilerplate, have an empty text. Unclosed elements end
with their parent, paragraphs, list items and cells where the next one begins; an unclosed comment or script runs to the end; other text that isn't well-formed markup
is text. Of regions with equal scores the first is taken. Repeated rows are extracted each. An empty table gives
no rows. Whole pages are read, in linear time. Other columns of the input are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import prepare

#: At most so many labelled pages are used for the scores, and none with more bytes.
LABELLED = 400
LABELLED_BYTES = 1 << 20
WORD_MOST, TAG_LEAST, TAG_MOST = 3.0, -2.0, -0.05

BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are no text of the page.
UNSEEN = "script style noscript template textarea title iframe object svg canvas math audio video".split()
BOILERPLATE = set("nav footer aside button select dialog menu head header".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Boilerplate unless they wrap content.
WEIGHED = {"form", "fieldset"}
#: Words of a class or id that mark boilerplate.
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget related recommended cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social comment "
    "comments commentlist disqus respond reply replies toolbar pagination pager copyright disclaimer search form".split())
#: Those by which even an <article> is a reader's comment.
COMMENT_MARKS = set("comment comments commentlist respond reply replies".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: The open elements that each of these ends.
ENDED_BY = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "thead", "tbody"},
    "tfoot": {"td", "th", "tr", "thead", "tbody"}}
#: Never boilerplate by their class: they hold the content.
HOLDERS = {"html", "body", "main", "article"}

#: A tag ends before the next "<", so that no search runs further than that and the scan stays linear.
_REST = r"(?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<unseen>{'|'.join(UNSEEN)})\b{_REST}>.*?(?:</(?P=unseen)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_REST})>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^<>]*)>"
    r"|<[!?/][^<>]*>",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What a part of the page with readers' comments begins with.
_COMMENTS = re.compile(
    r"\s*(?:<(?:div|header)\b[^<>]*>\s*)?<h[1-6]\b[^<>]*>\s*(?:\d{1,9}\s+)?(?:reader\s+)?(?:comments?|replies|responses)\b[^<]{0,40}</h", re.I)


def parsed(attributes: str) -> dict[str, str]:
    """Values by lower-cased name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), "".join(values))
    return found


def is_boilerplate(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """By name or role, or because it isn't shown, whatever it holds."""
    if name in HOLDERS:
        return False
    if name in BOILERPLATE and not (name == "header" and in_article):
        return True
    return bool(attributes) and (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or attributes.get("role", "").strip().lower() in ROLES
        or bool(_UNSHOWN.search(attributes.get("style", ""))))


def _marks(attributes: dict[str, str]) -> set[str]:
    names = " ".join(attributes[key] for key in ("class", "id") if key in attributes)
    return MARKS.intersection(_PART.findall(_CAMEL.sub(" ", names).lower()))


def is_comment(name: str, attributes: dict[str, str]) -> bool:
    """An <article> that is a reader's comment: it holds no content of its own."""
    return name == "article" and bool(COMMENT_MARKS & _marks(attributes))


def is_marked(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """By name, class, id or role, which `page_tokens` weighs against the words inside. A heading heads what follows it."""
    if name in WEIGHED or is_comment(name, attributes):
        return True
    if not attributes or name in HOLDERS or name in HEADINGS:
        return False
    parts = _marks(attributes)
    return bool(parts - {"header"} or parts and not in_article) or attributes.get("role", "").strip().lower() == "form"


class _Weights:
    """Words of the marked elements of a page, which are numbered, and of what they are weighed against."""

    def __init__(self):
        self.all = self.link = self.held = 0
        self.holders: dict[int, list[int]] = {}  # number: words at its begin, and then inside
        self.marked: list[list[int]] = []  # holder, and the three sums, which turn from those before into those inside

    def sums(self) -> list[int]:
        return [self.all, self.link, self.held]

    def content(self) -> set[int]:
        """The marked elements that hold most of the words around them, not mainly links: they wrap content."""
        out = set()
        for number, (holder, words, links, held) in enumerate(self.marked):
            own, scope = (words, self.holders[holder]) if holder else (held, self.held) if self.held else (words, self.all)
            if 2 * own > scope and 2 * links <= words:
                out.add(number)
        return out


def page_tokens(page: str) -> Iterator[tuple[str, str, int]]:
    """(kind, value, holder) in page order.

    kind "word": value is a piece of text outside boilerplate; "link": such a piece inside a link; "aside": inside
    boilerplate; "tag": value is the tag's name, with a slash in front if it ends an element. holder is the number of the
    innermost <article> or <main>, 0 outside.
    """
    weights = _Weights()
    tokens = list(_tokens(page, set(), weights))
    content = weights.content()
    return iter(_tokens(page, content, _Weights()) if content else tokens)


def _tokens(page: str, content: set[int], weights: _Weights) -> Iterator[tuple[str, str, int]]:
    """See `page_tokens`. content: the marked elements that are no boilerplate."""
    stack: list[str] = []
    opened: Counter = Counter()
    blocks: list[int] = []  # depths of open block elements
    hard: list[int] = []  # depths of open boilerplate elements by name or role
    soft: list[tuple[int, int]] = []  # (depth, number) of open marked elements
    bad: list[int] = []  # depths of open marked elements that are boilerplate
    holders: list[tuple[int, int]] = []  # (depth, number)
    number = last = 0

    def text(piece: str):
        kind = "aside" if hard or bad else "link" if opened["a"] else "word"
        value = entities.unescape(piece)
        if not hard:
            n = len(value.split())
            weights.all += n
            weights.link += n if opened["a"] else 0
            weights.held += n if holders else 0
        return kind, value, holders[-1][1] if holders else 0

    def close(depth: int):
        """End all elements deeper than `depth`."""
        while len(stack) > depth:
            opened[stack.pop()] -= 1
        for depths in (blocks, hard, bad):
            while depths and depths[-1] > depth:
                depths.pop()
        while soft and soft[-1][0] > depth:
            mark = weights.marked[soft.pop()[1]]
            mark[1:] = [now - before for now, before in zip(weights.sums(), mark[1:])]
        while holders and holders[-1][0] > depth:
            ended = holders.pop()[1]
            weights.holders[ended] = weights.all - weights.holders[ended]

    for m in _TOKEN.finditer(page):
        if m.start() > last:
            yield text(page[last:m.start()])
        last = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        ends = m["end"] or m["end2"]
        rest = m["rest"] or m["rest2"] or ""
        if ends:
            if opened[name]:
                depth = len(stack)
                while stack[depth - 1] != name:
                    depth -= 1
                close(depth - 1)
        elif name not in VOID and not rest.endswith("/"):
            attributes = parsed(rest) if rest else {}
            # An element whose end tag may be left out ends where one begins that it cannot hold.
            while name in BLOCKS and blocks and (stack[blocks[-1] - 1] == "p" or stack[blocks[-1] - 1] in ENDED_BY.get(name, ())):
                close(blocks[-1] - 1)
            stack.append(name)
            opened[name] += 1
            if name in BLOCKS:
                blocks.append(len(stack))
            holder = holders[-1][1] if holders else 0
            if name in ("article", "main") and not is_comment(name, attributes):
                number += 1
                holders.append((len(stack), number))
                weights.holders[number] = weights.all
            if is_boilerplate(name, attributes, bool(holders)):
                hard.append(len(stack))
            elif is_marked(name, attributes, bool(holders)) or name in ("section", "div") and _COMMENTS.match(page, m.end()):
                if len(weights.marked) not in content:
                    bad.append(len(stack))
                soft.append((len(stack), len(weights.marked)))
                weights.marked.append([holder, *weights.sums()])
        yield "tag", ("/" if ends else "") + name, holders[-1][1] if holders else 0
    if last < len(page):
        yield text(page[last:])
    close(0)


def spanned_tokens(page: str) -> tuple[list[tuple[str, str, int]], dict[int, tuple[int, int]]]:
    """The tokens of a page, and for each <article> or <main> the first of its tokens and the one after its last."""
    tokens, spans, open_ones = [], {}, []
    for i, token in enumerate(page_tokens(page)):
        tokens.append(token)
        kind, value, holder = token
        while open_ones and open_ones[-1] > holder:  # numbers grow with depth
            number = open_ones.pop()
            spans[number] = (spans[number][0], i)
        if holder and (not open_ones or open_ones[-1] < holder):
            open_ones.append(holder)
            spans[holder] = (i, i + 1)
    for number in open_ones:
        spans[number] = (spans[number][0], len(tokens))
    return tokens, spans


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def fit_scores(labelled: list[tuple[str, str]]) -> dict[str, float]:
    """Log odds of each kind of token from (html, text) pairs, words above zero and tags below.

    The content of a labelled page reaches from the first to the last piece of at least five words that occurs
    in its text.
    """
    inside, outside = Counter(), Counter()
    for page, text in labelled:
        tokens, known = list(page_tokens(page)), _squeezed(text)
        hits = [i for i, (kind, value, _) in enumerate(tokens)
                if kind != "tag" and len(value.split()) >= 5 and _squeezed(value) in known]
        if not hits:
            continue
        for i, (kind, value, _) in enumerate(tokens):
            counts = inside if hits[0] <= i <= hits[-1] else outside
            if kind == "tag":
                counts[f"<{value}"] += 1
            else:
                counts[kind] += len(value.split())
    scores = {k: math.log((inside[k] + 1) / (outside[k] + 1)) for k in inside.keys() | outside.keys()}
    found = {k: min(max(v, TAG_LEAST), TAG_MOST) for k, v in scores.items() if k[0] == "<"}
    found["word"] = min(max(scores.get("word", 1.0), 0.5), WORD_MOST)
    found["link"] = min(max(scores.get("link", 0.0), 0.0), found["word"])
    return found | {"aside": 0.0}


def main_text(page: str | None, scores: dict[str, float]) -> str:
    """Text of the best region of a page."""
    if not page:
        return ""
    tokens, spans = spanned_tokens(page)
    best, best_from, best_to = 0.0, 0, 0
    total, begin = 0.0, 0
    words = []
    for i, (kind, value, _) in enumerate(tokens):
        if kind == "tag":
            words.append(0)
            total += scores.get(f"<{value}", TAG_LEAST / 2)
        else:
            words.append(len(value.split()) if kind != "aside" else 0)
            total += scores[kind] * words[-1]
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, best_from, best_to = total, begin, i + 1
    touched = {tokens[i][2] for i in range(best_from, best_to) if words[i]}
    for begin, end in (spans[h] for h in touched if h):
        best_from, best_to = min(best_from, begin), max(best_to, end)
    blocks, block = [], []
    for kind, value, _ in tokens[best_from:best_to]:
        if kind == "tag":
            name = value.lstrip("/")
            if name in BLOCKS:
                blocks.append(_squeezed("".join(block)))
                block = []
            elif name == "br":
                block.append(" ")
        elif kind != "aside":
            block.append(value)
    blocks.append(_squeezed("".join(block)))
    return "\n".join(b for b in blocks if b)


def _extracted(batches: Iterator[pa.RecordBatch], scores: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, scores) for page in batch["html"].to_pylist()]
        yield pa.record_batch({
            "page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def labelled_pages(pages: DataFrame, documents: DataFrame, most: int = LABELLED) -> list[tuple[str, str]]:
    """About `most` pairs (html, text), at most that many, of pages whose URL ends in the number of a document, which is their text."""
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^/]*/[a-z]+/(\d{1,18})", 1)
    known = pages.where(F.octet_length("html") <= LABELLED_BYTES).select("html", number.alias("number")).where("number <> ''")
    # Tasks send their first rows to the driver, so those that can't be among the first are left out before.
    share = math.ceil(min(1.0, 4 * most / max(pages.count(), 1)) * (1 << 32))
    order = F.pmod(F.xxhash64("number", "html"), F.lit(1 << 32))
    some = known.where(order < share).orderBy(order, "number", "html").limit(most).collect()
    some = sorted(some, key=lambda r: (r["number"], r["html"]))
    texts = documents.where(F.col("doc_id").isin([int(r["number"]) for r in some]) & (F.octet_length("text") <= LABELLED_BYTES)).groupBy(
        "doc_id").agg(F.min("text").alias("text")).collect()
    known_texts = {r["doc_id"]: r["text"] for r in texts}
    return [(r["html"], known_texts[int(r["number"])]) for r in some if int(r["number"]) in known_texts]


def extracted_pages(pages: DataFrame, scores: dict[str, float]) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html)."""
    prepare(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(
        partial(_extracted, scores=scores), "page_id long, url string, text string, n_chars long")
