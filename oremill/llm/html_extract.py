"""Main text of web pages by deducing the template of their host.

Tokens are the elements of a page, told apart by their path (tags, classes and ids of the elements around), and its
text blocks.  The occurrence vector of a token holds, for each page of the host, how often it occurs there.  Tokens with
the same vector are an equivalence class; a class with several tokens, on a good share of the pages, is part of the
template, and classes nest as their paths do.  Text that stands inside a template element is the content of one of the
template's slots.  Over all pages of the host a slot shows what it is: the article's slots hold much text that no other
page has, and few links; menus, notices and adverts repeat themselves.

Vectors are never gathered: pages with equal counts give equal hashes, and the hashes of all pages are combined by XOR,
so tokens with equal combinations (and equal numbers of pages and occurrences) are equivalent.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oremill.llm.common import blocks, stored, wide_hash

#: A class is part of the template with so many tokens, on this share of the host's pages.  A host needs so many pages.
CLASS_TOKENS, CLASS_SHARE, HOST_PAGES = 3, 0.1, 3
#: A slot is content with at most this share of its text in links, and at most this share found on other pages too.
MOST_LINKED, MOST_REPEATED = 0.5, 0.5
#: Where no element is marked as the article, a content slot has this share of the host's text, and blocks this long.
LEAST_SHARE, LEAST_BLOCK = 0.05, 25

#: Templates are broadcast up to this size; beyond it the pages of a host are spread over so many keys.
BROADCAST_BYTES, SALTS = 32 * 1024 * 1024, 64

# Elements of HTML, and words in the names of classes and ids.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea select button title head".split())
NOT_MAIN = frozenset("nav footer aside form fieldset menu dialog".split())
MAIN = frozenset("article main".split())
NOT_MAIN_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal"
    " nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer foot masthead topbar toolbar share social related recommended"
    " comment comments reply replies respond disqus discussion reader-comments newsletter subscribe subscription signup login search form skip copyright pagination pager".split()
)
#: An element with one of these as a part of a longer name may be the layout around an article.
LAYOUT_NAMES = frozenset("sidebar side share search notice notices banner nav navbar header footer skip topbar".split())
#: Kinds of elements besides those of blocks: named by a part of a name that is not of layouts, and an article in such a one.
MAYBE, WITHIN_MAYBE = -1.5, -1.25
#: The kind of what is inside an article, in an element whose name speaks against it: the slot's text decides.
DOUBTFUL = 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Reader comments by a part of a name, but for names that say whether a page has any.
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion".split())
STATES = frozenset("has no with without is enabled disabled open closed on off".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
MAIN_NAMES = frozenset("article post-content entry-content article-body story-body main-content post-body articlebody".split())
#: A paragraph ends where one of these begins, as do items and cells of their kind.
_ENDED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*+")
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_DIGITS = re.compile(r"\d+")


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _of_comments(name: str) -> bool:
    parts = set(re.split(r"[-_]+", name))
    return bool(parts & COMMENT_NAMES) and not parts & STATES


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[str, float]:
    """How a path names an element, and what its name says: -2 not the main text, -1 not unless an article is inside,
    ``MAYBE`` the same unless the page has another article, 1 the article, 0 nothing."""
    names: list[str] = []
    role = ""
    if attributes:
        for kind, *values in _NAME.findall(attributes):
            value = next((v for v in values if v), "").lower()
            if kind.lower() == "role":
                role = value.strip()
            else:
                names += value.split()
    parts = {part for name in names for part in (name, *re.split(r"[-_]+", name))}
    # On the whole page such names tell of its layout.
    unlike = set() if tag in ("html", "body") else parts & NOT_MAIN_NAMES
    if tag in MAIN or role in ("main", "article") or parts & MAIN_NAMES:
        kind = 1
    elif tag in NOT_MAIN or role in NOT_MAIN_ROLES or unlike & set(names) or (unlike and any(_of_comments(name) for name in names)):
        kind = -2
    elif unlike:
        kind = -1 if unlike <= LAYOUT_NAMES else MAYBE
    else:
        kind = 0
    # Numbers in names differ from page to page.
    return ".".join([tag, *sorted({_DIGITS.sub("#", n) for n in names})]), kind


class Path:
    """The elements around a text, as a chain: the innermost one's name and what is around it."""

    __slots__ = ("around", "doubtful", "hash", "slot")

    def __init__(self, around: Path | None, name: str, doubtful: bool = False):
        self.around, self.doubtful = around, doubtful
        self.hash = _path_hash(around.hash if around else 0, name)
        # Elements that only divide text have no slot of their own, so that all paragraphs of an article fill one.
        self.slot: Path = around.slot if around and not doubtful and name.split(".")[0] in _DIVIDERS else self


class Block:
    __slots__ = ("kind", "linked", "path", "text")

    def __init__(self, path: Path, kind: float, text: str, linked: int):
        self.path, self.kind, self.text, self.linked = path, kind, text, linked


_DIVIDERS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre tr td th tbody thead tfoot table figcaption caption".split())


@lru_cache(maxsize=50_000)
def _path_hash(around: int, name: str) -> int:
    return _hash(f"{around}/{name}")


class Markup:
    """The tags of a page one by one, in time that grows with the page however broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.last_end = page.rfind(">")
        # Quotes outside of which no tag ends any more; a tag that comes upon one need not look further.
        self.open_quotes: set[int] = set()

    def _tag_end(self, at: int) -> int:
        """Where an open tag ends: behind the first ``>`` outside quotes, or the first of all if a quote stays open."""
        page, here, seen = self.page, at, []
        while True:
            here = _PLAIN.match(page, here).end()
            if here == len(page) or here in self.open_quotes:
                break
            if page[here] == ">":
                return here + 1
            seen.append(here)
            closing = page.find(page[here], here + 1)
            if closing < 0:
                break
            here = closing + 1
        self.open_quotes.update(seen)
        return page.find(">", at) + 1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """The next tag or comment: start, end, slash, name and attributes; a comment or declaration has no name."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                closing = page.find("-->", at + 4)
                return at, closing + 3 if closing >= 0 else len(page), "", "", ""
            if at > self.last_end:  # only comments need no end
                at = page.find("<!--", at)
                if at < 0:
                    return None
                continue
            if page[at + 1] in "!?":
                return at, page.find(">", at) + 1, "", "", ""
            if tag := _TAG.match(page, at):
                end = self._tag_end(tag.end())
                return at, end, tag[1], tag[2].lower(), page[tag.end() : end - 1]
            at += 1
        return None


def parse(page: str) -> tuple[list[Block], list[Path]]:
    """The text blocks of a page and the paths of its elements, in page order.

    Broken markup is read as browsers do: a paragraph ends where a block begins, an end tag without its start is
    ignored, and elements that are still open end with the page.  A block is text between the starts and ends of block
    elements, white space made one blank, character references decoded.  Its kind is -1 inside an element that is not
    main text by its tag or name, else 1 inside an article, else 0.  Names of layouts, as parts of longer names, do not hold
    for an article inside; nor do other such parts, if the page has no article but there.  On ``html`` and ``body`` no
    such names hold.  Inside an article such a part of a name, or any name of a heading, is a doubt that the template has to
    settle: the kind is ``DOUBTFUL``.  Elements may nest to any depth.
    """
    found: list[Block] = []
    elements: list[Path] = []
    stack: list[tuple[str, Path, float]] = [("", Path(None, ""), 0)]
    still_open: Counter[str] = Counter()
    text: list[str] = []
    linked = in_link = at = 0
    size, lowered, markup = len(page), None, Markup(page)

    def close_block() -> None:
        nonlocal linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                _, path, kind = stack[-1]
                found.append(Block(path, kind, words, min(linked, len(words))))
            text.clear()
        linked = 0

    while at < size:
        token = markup.next(at)
        end = token[0] if token else size
        if end > at:
            text.append(page[at:end])
            if in_link:
                linked += end - at
        if not token:
            break
        _, at, slash, tag, attributes = token
        if not tag:
            continue
        if tag == "a":
            in_link = not slash
            continue
        if slash:
            if tag in BLOCK:
                close_block()
                if still_open[tag]:
                    while True:
                        ended = stack.pop()[0]
                        still_open[ended] -= 1
                        if ended == tag:
                            break
                    in_link = 0
            continue
        if tag in RAW and not attributes.endswith("/"):
            lowered = page.lower() if lowered is None else lowered
            if len(lowered) != size:  # a letter whose lower case is longer
                closing = re.compile(rf"</{re.escape(tag)}[\s>/]", re.I).search(page, at)
                stop = closing.start() if closing else -1
            else:
                stop = lowered.find(f"</{tag}", at)
            # What is never closed hides the rest of the page, as in browsers, but for the head.
            at = at if stop < 0 and tag == "head" else size if stop < 0 else page.find(">", stop) + 1 or size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCK:
            continue
        close_block()
        if tag in VOID:
            continue
        while len(stack) > 1 and tag in _ENDED_BY.get(stack[-1][0], ()):
            still_open[stack.pop()[0]] -= 1
        name, kind = _element(tag, attributes)
        _, around, outer = stack[-1]
        doubtful = outer in (1, DOUBTFUL) and (kind in (-1, MAYBE) or (kind == -2 and tag in HEADINGS))
        inner = Path(around, name, doubtful)
        if doubtful or (outer == DOUBTFUL and kind >= 0):
            kind = DOUBTFUL
        elif outer in (-1, MAYBE) and kind == 1:
            kind = 1 if outer == -1 else WITHIN_MAYBE
        elif outer == WITHIN_MAYBE:
            kind = WITHIN_MAYBE if kind >= 0 else -2
        else:
            least = min(outer, kind)
            kind = least if least < 0 else max(outer, kind)
        stack.append((tag, inner, kind))
        still_open[tag] += 1
        elements.append(inner)
    close_block()
    alone = not any(b.kind == 1 for b in found)
    for b in found:
        b.kind = 1 if alone and b.kind == WITHIN_MAYBE else max(b.kind, -1)
    return found, elements


TOKENS = "host string, page long, tokens array<struct<token:long,n:int,slot:long,kind:int,chars:int,linked:int,text:boolean>>"


def tokens(pages: DataFrame) -> DataFrame:
    """Of each page, the elements by their paths and the text blocks, with how often each occurs."""
    arrow = pa.struct([("token", pa.int64()), ("n", pa.int32()), ("slot", pa.int64()), ("kind", pa.int32()), ("chars", pa.int32()), ("linked", pa.int32()), ("text", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            rows = []
            for page in block.column("html").to_pylist():
                found, elements = parse(page or "")
                seen: dict[int, dict] = {}
                for path in elements:
                    token = path.hash
                    row = seen.setdefault(token, {"token": token, "n": 0, "slot": token, "kind": 0, "chars": 0, "linked": 0, "text": False})
                    row["n"] += 1
                for b in found:
                    slot = b.path.slot.hash
                    token = _hash(f"{slot} {b.text}")
                    row = seen.setdefault(token, {"token": token, "n": 0, "slot": slot, "kind": b.kind, "chars": len(b.text), "linked": b.linked, "text": True})
                    row["n"] += 1
                rows.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays([block.column("host"), block.column("page"), pa.array(rows, pa.list_(arrow))], ["host", "page", "tokens"])

    return pages.select("host", "page", "html").mapInArrow(run, TOKENS)


def templates(pages: DataFrame) -> DataFrame:
    """Of each host its slots (``slots``) and those that hold the article (``main``), as hashes of paths.

    Only hosts of ``HOST_PAGES`` pages have a row.  Everything about a host is summed before it is shuffled, so a host
    may have any number of pages.  What is gathered for a host are template elements that ``CLASS_SHARE`` of its pages
    have, ten times as many as one page has at the most.
    """
    each = tokens(pages.where("host != ''"))
    rows = each.select("host", "page", F.inline("tokens"))
    vector = [F.bit_xor(h).alias(f"v{i}") for i, h in enumerate(wide_hash(F.col("page"), F.col("n")))]
    once = rows.groupBy("host", "token", "slot", "text").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("times"),
        *vector,
        F.max("kind").alias("kind"),
        F.min("kind").alias("least_kind"),
        F.sum(F.col("n") * F.col("chars")).alias("chars"),
        F.sum(F.col("n") * F.col("linked")).alias("linked"),
    )
    once = stored(once, "template-tokens")
    hosts = pages.where("host != ''").groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).where(F.col("host_pages") >= HOST_PAGES)
    hosts = stored(hosts, "template-hosts")  # the join then has a shuffle of its own, in which a large host is split
    # Blocks that only one page has are no template tokens, and far the most of all: they only count for their slot.
    frequent = once.join(hosts, "host").where((F.col("pages") >= F.greatest(F.lit(2), F.ceil(F.col("host_pages") * CLASS_SHARE))))
    same = ["host", "pages", "times", "v0", "v1"]
    classes = frequent.groupBy(*same).agg(F.count(F.lit(1)).alias("size"))
    large = classes.where(F.col("size") >= CLASS_TOKENS).select(*same)
    slots = frequent.where(~F.col("text")).join(large, same, "left_semi").select("host", "slot")
    repeated = F.when(F.col("pages") > 1, F.col("chars")).otherwise(0)
    content = once.where("text").groupBy("host", "slot").agg(
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.sum(repeated).alias("repeated"),
        F.sum("times").alias("blocks"),
        F.max("kind").alias("kind"),
        F.min("least_kind").alias("least_kind"),
    )
    of_host = content.groupBy("host").agg(F.sum("chars").alias("all_chars"), F.max(F.col("kind") == 1).alias("marked"))
    judged = slots.join(content, ["host", "slot"], "left").join(of_host, "host", "left")
    fresh = (F.col("linked") <= MOST_LINKED * F.col("chars")) & (F.col("repeated") <= MOST_REPEATED * F.col("chars"))
    ample = (F.col("chars") >= LEAST_SHARE * F.col("all_chars")) & (F.col("chars") >= LEAST_BLOCK * F.col("blocks"))
    settled = F.when(F.col("kind") == DOUBTFUL, fresh).otherwise(F.col("kind") == 1)
    named = F.when(F.col("marked"), settled).otherwise(fresh & ample)
    main = F.coalesce((F.col("least_kind") >= 0) & named, F.lit(False))
    return judged.groupBy("host").agg(F.collect_list("slot").alias("slots"), F.collect_list(F.when(main, F.col("slot"))).alias("main"))


def _main_text(page: str | None, slots: frozenset[int] | None, main: frozenset[int]) -> str:
    """The text of the article's slots, a block to a line.

    A block belongs to the innermost element of the template around it.  A page whose host has no template, or that
    has none of its article, is read by the names of its elements: the article if there is one, else all blocks of
    kind 0 that are not mostly links.
    """
    found, elements = parse(page or "")
    if slots:
        # An element comes after those around it, so each is looked at once.
        inside: dict[Path, bool] = {}
        for path in elements:
            inside[path] = path.hash in main if path.hash in slots else not path.doubtful and inside.get(path.around, False)
        kept = [b.text for b in found if b.kind >= 0 and inside.get(b.path.slot, False)]
        if kept:
            return "\n".join(kept)
    marked = any(b.kind == 1 for b in found)
    return "\n".join(b.text for b in found if (b.kind == 1 if marked else b.kind == 0 and b.linked <= MOST_LINKED * len(b.text)))


def _with_templates(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Join each page to its host's template without gathering a host's pages.

    Templates go to all executors while their size is below a bound; beyond it each is copied to ``SALTS`` keys over
    which the pages of a host are spread.
    """
    held = model.agg(F.count(F.lit(1)).alias("hosts"), F.sum(F.size("slots") + F.size("main")).alias("paths")).first()
    if 100 * held["hosts"] + 8 * (held["paths"] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(model), "host", "left")
    salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, ["host", "salt"], "left")


def extract(pages: DataFrame) -> DataFrame:
    """Add ``text``, the main text of the whole ``html``, and ``n_chars``, its code points.

    Null and empty pages have an empty text.  The host is the authority of ``url`` in lower case; pages without one have
    no template.  Repeated pages count as pages.  Other columns pass through, but for those named like the new ones.
    """
    rest = [c for c in pages.columns if c not in ("text", "n_chars", "host", "page", "slots", "main")]
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))
    rows = pages.select(*rest, host.alias("host"))
    model = templates(rows.select("host", "html", F.xxhash64("page_id", "html").alias("page")))
    joined = _with_templates(rows, stored(model, "templates"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*rest).schema.fields), "text string, n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = lru_cache(maxsize=1_000)(frozenset)
        for block in blocks(batches, "html"):
            texts = []
            for page, slots, main in zip(*(block.column(c).to_pylist() for c in ("html", "slots", "main")), strict=True):
                texts.append(_main_text(page, sets(tuple(slots)) if slots else None, sets(tuple(main or ()))))
            kept = [block.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*rest, "text", "n_chars"])

    return joined.select(*rest, "slots", "main").mapInArrow(run, fields)


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and the length of that."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
