"""HTML extraction by templates of nested classes of tokens, and names of elements and classes.

Every page is read as tokens: an opening tag with the tags it lies in is one token, and the
text directly in it belongs to its slot. Over the pages of a host, a token has an occurrence
vector (how often it is in each page). Tokens with equal vectors form a class; a class is
valid if it is in at least ``min_share`` of the host's pages, of at least ``min_pages`` pages.
Vectors are compared by a sum of hashes, so a host of any size is counted with partial sums
and never put together in one task. Classes are nested by the tokens that theirs lie in, to the
host's template, and their slots are judged by the share of pages that have the same text there
(``fixed_slots``): on all pages, text of slots that are the template's is furniture. What pages
have beyond the template is text. Menus and adverts may differ from page to page, so names tell
more furniture on all pages, and all of it on hosts without a template. The main
text is what lies in an article or main element, if the page has one, and otherwise all that
does not lie in a menu, header, footer, sidebar, notice, advert, form or comment by its
element's name or by a whole name in its class, id or role. Such names say nothing on html and
body, and a form, header or layout name (``LAYOUT``) nothing on an element that holds more than
half of the page's own text: of what lies outside all other furniture, and in an article or
main element if there is such text. Hosts with fewer pages have no template.

Character references are decoded, white space inside a block becomes one space, and blocks
are joined by an empty line. Defined results: null or empty html gives an empty text. A null
url has an empty host, whose pages form one site. Unclosed and cut-off tags are taken as they
are. Repeated rows each give a row; other columns are not read. A very long page is parsed by
one task, which holds its open elements; no pages give no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch
from arrivals_engine.llm.urls import with_address

#: Names of elements, by what they mean.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre search section select summary table tbody td tfoot th thead title "
    "tr ul".split()
)
MAIN = frozenset(["article", "main"])
FURNITURE = frozenset("head nav footer aside menu dialog button select search noscript".split())
#: Furniture, unless most of the page's own text lies in it.
AROUND = frozenset(["form", "fieldset"])
#: Elements that their own kind, or a block, closes when it opens.
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
#: Elements that name the text after them; in an article or main element they belong to it.
LABELS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption figcaption legend summary".split())
#: Whole names in a class, id or role: of parts of the layout, which may also be around the text,
_PLACE = r"(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global)[-_]?)?"
LAYOUT = re.compile(
    _PLACE + r"(?:nav|navbar|navigation|menu|sidebar|side|footer|header|banner)"
    r"|(?:nav|menu)[-_](?:bar|menu|links|list)|sidebar[-_](?:left|right|primary|secondary)"
    r"|widget(?:[-_]area)?|notices?|alert|breadcrumbs?",
    re.IGNORECASE,
)
#: and of what never is around it.
MARKS = re.compile(
    r"ads?|ads?[-_](?:slot|unit|box|banner|container|wrapper)|advert\w*|sponsor\w*|promo\w*"
    r"|(?:post[-_])?comments?(?:[-_](?:area|list|section|form))?|respond|disqus\w*"
    r"|cookies?(?:[-_](?:notice|banner|consent|bar))?|consent|popup|modal|login"
    r"|(?:social[-_])?share(?:[-_](?:buttons|bar|links))?|social(?:[-_](?:links|icons|media))?"
    r"|related(?:[-_](?:posts|articles|links|content))?|subscribe|newsletter(?:[-_](?:signup|form))?",
    re.IGNORECASE,
)

_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|svg|iframe|textarea|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<([/!?]?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_attribute = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)


@dataclass
class Element:
    name: str
    path: str
    furniture: bool
    main: bool
    #: The length of the path of the element around it.
    up: int = 0
    #: The innermost element, from this one up, that is furniture unless most text lies in it.
    layout: Layout | None = None


@dataclass
class Layout:
    outer: Layout | None
    chars: int = 0


@dataclass
class Block:
    """Text of one block: where it lies, and its pieces."""

    at: Element
    furniture: bool = False
    pieces: list[str] = field(default_factory=list)

    @property
    def path(self) -> str:
        return self.at.path

    @property
    def main(self) -> bool:
        return self.at.main

    @property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def _marks(attributes: str) -> tuple[str, str]:
    found = {k.lower(): v.strip("\"'") for k, v in _attribute.findall(attributes)}
    own = " ".join(found.get(k, "") for k in ("class", "id", "role")).strip()
    return found.get("class", ""), own


def parsed(page: str | None) -> tuple[list[str], list[Block]]:
    """The tokens (paths of opened elements) and the blocks with text, both in page order."""
    opened, blocks = elements(page)
    return [e.path for e in opened], blocks


def elements(page: str | None) -> tuple[list[Element], list[Block]]:
    """The opened elements and the blocks with text, both in page order."""
    opened: list[Element] = []
    blocks: list[Block] = []
    open_: list[Element] = [Element("", "", False, False)]
    at, fresh = 0, True
    page = page or ""

    def put(text: str) -> None:
        nonlocal fresh
        if not text:
            return
        if fresh:
            blocks.append(Block(open_[-1]))
            fresh = False
        blocks[-1].pieces.append(text)

    for m in _token.finditer(page):
        put(page[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        name, closing = m[3].lower(), m[2] == "/"
        if m[2] in ("!", "?"):
            continue
        if name in BLOCK:
            fresh = True
        elif name == "br":
            put(" ")
        if closing:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].name == name:
                    del open_[k:]
                    break
            continue
        if name in VOID:
            continue
        if name in BLOCK:
            _close_implied(open_, name)
        kind, own = _marks(m[4])
        parent = open_[-1]
        path = f"{parent.path}/{name}" + (f".{kind}" if kind else "")
        furniture, around = _furniture(name, own, parent)
        furniture = parent.furniture or furniture
        main = parent.main or name in MAIN or own.endswith("main")
        layout = Layout(parent.layout) if around else parent.layout
        open_.append(Element(name, path, furniture, main, len(parent.path), layout))
        opened.append(open_[-1])
    put(page[at:])
    blocks = [b for b in blocks if b.text]
    _judge(blocks)
    return opened, blocks


def _furniture(name: str, own: str, parent: Element) -> tuple[bool, bool]:
    """Whether the element is furniture for certain, and whether it is by its layout only."""
    if name in FURNITURE:
        return True, False
    header = name == "header" and not parent.main
    if name in ("html", "body") or name in MAIN:
        return False, False
    names = [x for x in own.split() if not (name == "header" and x.lower() == "header")]
    if any(map(MARKS.fullmatch, names)):
        return True, False
    return False, header or name in AROUND or any(map(LAYOUT.fullmatch, names))


def _judge(blocks: list[Block]) -> None:
    """Says of each block whether it lies in furniture."""

    def around(block: Block) -> Iterator[Layout]:
        layout = block.at.layout
        while layout is not None:
            yield layout
            layout = layout.outer

    own = [b for b in blocks if not b.at.furniture]
    own = [b for b in own if b.main] or own
    total = 0
    for b in own:
        n = len(b.text)
        total += n
        for layout in around(b):
            layout.chars += n
    for b in blocks:
        b.furniture = b.at.furniture or any(2 * x.chars <= total for x in around(b))


def _close_implied(open_: list[Element], name: str) -> None:
    """A block closes an open paragraph, and list items and cells those of their kind."""
    for k in range(len(open_) - 1, 0, -1):
        here = open_[k].name
        if here == "p" or (here == name and name in CLOSES_ITSELF):
            del open_[k:]
            return
        if here in BLOCK:
            return


COUNTS = "host string, page long, token string, up int, main boolean, named boolean, n long, slot long"


def _occurrences(pages: DataFrame) -> DataFrame:
    """(host, page, token, up, main, named, n, slot): how often each page has the token, and a
    hash of its slot. The first `up` characters of a token are the token it lies in; main and
    named say whether it lies in an article or main element, or in furniture by its names."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for host, page, text in zip(rows["host"], rows["page"], rows["html"], strict=True):
                opened, blocks = elements(text)
                n: dict[str, int] = {}
                at: dict[str, tuple[int, bool, bool]] = {}
                slots: dict[str, list[str]] = {}
                for e in opened:
                    n[e.path] = n.get(e.path, 0) + 1
                    up, main, named = at.get(e.path, (0, False, True))
                    at[e.path] = (max(up, e.up), main or e.main, named and e.furniture)
                for b in blocks:
                    slots.setdefault(b.path, []).append(b.text)
                out += [
                    (host, page, token, *at[token], k, "\n".join(slots.get(token, ())))
                    for token, k in n.items()
                ]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in COUNTS.split(", ")])

    raw = pages.select("host", F.xxhash64("page_id", "html").alias("page"), "html").mapInPandas(
        count, COUNTS.replace("slot long", "slot string")
    )
    return raw.withColumn("slot", F.xxhash64("slot"))


def templates(pages: DataFrame, *, min_pages: int = 3, min_share: float = 0.5) -> DataFrame:
    """(host, classes, frame). classes: the valid classes, each with whether its tokens are once
    in each page that has them, and its tokens with the share of pages whose slot has
    the commonest text. frame: the tokens of classes that are once in each page, each with
    whether its slot has the same text on all pages. Both are bounded by the size of pages: each
    page has at least min_share of them on average."""
    of_host = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    # Texts are counted before tokens, so a token of very many pages is never in one task as a whole.
    texts = (
        _occurrences(pages)
        .groupBy("host", "token", "slot")
        .agg(
            F.count("*").alias("pages"),
            F.max("n").alias("most"),
            F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("vector"),
            F.max("up").alias("up"),
            F.max("main").alias("main"),
            F.min("named").alias("named"),
        )
    )
    vectors = (
        texts.groupBy("host", "token")
        .agg(
            (F.max("pages") / F.sum("pages")).alias("alike"),
            F.sum("pages").alias("pages"),
            F.max("most").alias("most"),
            F.sum("vector").alias("vector"),
            F.max("up").alias("up"),
            F.max("main").alias("main"),
            F.min("named").alias("named"),
        )
        .join(of_host, "host")
        .where((F.col("host_pages") >= min_pages) & (F.col("pages") >= F.col("host_pages") * min_share))
    )
    classes = vectors.groupBy("host", "vector", "pages", "most").agg(
        F.collect_list(F.struct("token", "up", "main", "named", "alike")).alias("tokens"),
    )
    found = classes.groupBy("host").agg(
        F.collect_list(F.struct((F.col("most") == 1).alias("once"), "tokens")).alias("classes")
    )
    once = F.flatten(F.transform(F.filter("classes", lambda c: c["once"]), lambda c: c["tokens"]))
    same = F.transform(once, lambda x: F.struct(x["token"], (x["alike"] == 1).alias("same")))
    return found.withColumn("frame", same)


def fixed_slots(classes: list, same_share: float = 0.9, min_size: int = 2) -> list[str]:
    """The tokens of a host whose text is the template's: nests the classes and judges the slots.

    A class that repeats in a page is one class in each slot that its tokens lie in. One of fewer
    than min_size tokens is none: its text belongs to the slot around it. Every other class lies
    in the class of the token around its first token. A slot is fixed if at least same_share of
    the pages have the same text in each part of it. The slots of a class that repeats are one
    record: they are the template's only if they, and those of all classes nested in it, are
    fixed, so the labels of a record stay, and so do headings and labels in article or main
    elements. If no slot changes that the names let through, there is no telling what is
    template: the pages are copies. The same holds for what lies in article or main elements
    by itself."""
    tokens = {t["token"]: t for c in classes for t in c["tokens"]}
    class_of = {t["token"]: k for k, c in enumerate(classes) for t in c["tokens"]}
    inwards = sorted(tokens, key=len)
    around = {token: token[: tokens[token]["up"]] for token in inwards}
    nested: dict[str, tuple[int, str]] = {}  # a token's class, and the slot that it repeats in
    for token in inwards:
        k = class_of[token]
        if classes[k]["once"]:
            nested[token] = (k, "")
        elif class_of.get(around[token]) == k:
            nested[token] = nested[around[token]]
        else:
            nested[token] = (k, around[token])
    size = Counter(nested.values())
    home: dict[str, str] = {}  # the token whose slot a token's text belongs to
    alike: dict[str, float] = {}
    outer: dict[tuple[int, str], tuple[int, str] | None] = {}  # the class that a class lies in
    for token in inwards:
        at, own = home.get(around[token]), nested[token]
        home[token] = token if own[1] == "" or size[own] >= min_size or at is None else at
        outer.setdefault(own, nested[at] if at else None)
        alike[home[token]] = min(alike.get(home[token], 1.0), tokens[token]["alike"])

    changing = {token for token, share in alike.items() if share < same_share}
    records = set()  # repeating classes with a slot that changes, in them or in a class nested in them
    for token in changing:
        k = nested[token]
        while k is not None:
            if not classes[k[0]]["once"]:
                records.add(k)
            k = outer[k]
    changing_main = {tokens[token]["main"] for token in changing if not tokens[token]["named"]}
    fixed = []
    for token, at in home.items():
        told = bool(changing_main)
        if tokens[token]["main"]:
            name = token[tokens[token]["up"] + 1 :].split(".", 1)[0]
            told = True in changing_main and name not in LABELS
        if told and at not in changing and nested[at] not in records:
            fixed.append(token)
    return fixed


def main_text(page: str | None, constant: frozenset[str]) -> str:
    """The blocks of the remaining slots. constant: tokens whose slot is the template's."""
    blocks = parsed(page)[1]
    kept = [b for b in blocks if not b.furniture]
    kept = [b for b in kept if b.main] or kept
    return "\n\n".join(b.text for b in kept if b.path not in constant)


def extracted(pages: DataFrame, **how) -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of pages."""
    scratch = Scratch(pages.sparkSession, "html")
    rows = with_address(pages, "url").select("page_id", "url", "html", "host")
    constant_of = F.udf(lambda classes: fixed_slots(classes), "array<string>")
    found = templates(rows, **how).select("host", constant_of("classes").alias("constant"))
    found = scratch.put(found, "templates")

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, constants in batches:
            yield pd.Series(
                [
                    main_text(t, frozenset(() if c is None else c))
                    for t, c in zip(texts, constants, strict=True)
                ],
                dtype=object,
            )

    return (
        rows.join(found, "host", "left")
        .select("page_id", "url", text_of("html", "constant").alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
