"""Main text of web pages by two-pass block rules.

A page is read once as a stream of tags and text.  Block tags part the text
into blocks; each block knows its length, the share of its characters inside
links, its stop-word density, and what it stands in: a navigation, form or
footer (by tag, or by the words of a class, id or role), or an article.  Body,
article and main end the furniture they stand in, and class words say nothing
of an element that holds an article or main.  Text of svg, math, object and
noscript counts inside an article and nowhere else; a head that is not closed
ends with the first text or block that cannot stand in it.

First pass, each block on its own: blocks in furniture and blocks made of links
are bad, blocks with many stop words, or long ones with some, are good, and what
is short or has few stop words stays open.  Second pass: an open block takes the
label of its nearest decided neighbours on both sides, furniture left out;
between a good and a bad one it is good where it has some stop words, stands in
an article, or is nearer to the good one.  An article decides nothing else: the
labels of a page without article or main tags come about in the same way.  Where
a page has no good block at all, its open ones are taken.

Defined results: null or empty html gives an empty text; markup that is never
closed ends with the page; repeated rows are read alike; an empty table gives
an empty result; extra columns pass through.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, text_or_empty

# Frequent function words of the languages that are told apart here.
STOP_WORDS = frozenset(
    (
        "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you "
        "aber als am an auch auf aus bei das dass dem den der des die ein eine einer es für hat ich im in ist mit nicht noch nur oder sich sie sind so über um und von war wie wird zu zum zur "
        "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sur un une vous y "
        "al como con de del el ella en es esta este fue ha la las le lo los más no o para pero por que se si sin sobre su sus un una y"
    ).split()
)
_RAW = "script|style|template|textarea|iframe"
_EMBEDDED = frozenset("math noscript object svg".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z!?][^>]*+(?:>|\Z)"
    r"|<!\[CDATA\[|\]\]>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
FURNITURE_TAGS = frozenset("aside button dialog footer form head menu nav option select title".split())
#: Words of a class, id or role that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies "
    "disclaimer disqus footer login masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo promoted promotion related "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_VOID = frozenset("hr".split())
_INK = re.compile(r"\w+", re.UNICODE)

SHORT, LONG = 70, 200  # characters
FEW, MANY = 0.20, 0.30  # stop words among words
MOST_LINKS = 0.5

GOOD, BAD, OPEN = 1, 0, -1


class Block:
    __slots__ = ("text", "linked", "furniture", "article")

    def __init__(self, text: str, linked: int, furniture: bool, article: bool):
        self.text, self.linked, self.furniture, self.article = text, linked, furniture, article


class _Open:
    """An open block tag; whether it is furniture is known once it is closed."""

    __slots__ = ("tag", "up", "by_tag", "by_words", "article", "holds", "known")

    def __init__(self, tag: str, attributes: str, up: _Open | None):
        self.tag, self.up, self.holds, self.known = tag, up, False, None
        self.article = tag in ("article", "main") or (up is not None and up.article)
        self.by_tag = tag in FURNITURE_TAGS or (tag == "header" and not self.article)
        self.by_words = tag != "html" and tag not in _OWN_GROUND and _furniture_words(attributes)

    def furniture(self) -> bool:
        chain, at = [], self
        while at is not None and at.known is None:
            chain.append(at)
            at = at.up
        above = at.known if at is not None else False
        for x in reversed(chain):
            above = x.known = x.tag not in _OWN_GROUND and (above or x.by_tag or (x.by_words and not x.holds))
        return above


#: Tags that end the furniture around them.
_OWN_GROUND = frozenset("article body main".split())


def _furniture_words(attributes: str) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if not FURNITURE_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """The non-empty blocks of a page, in its order."""
    out: list[Block] = []
    places: list[_Open | None] = []  # what each block stands in
    stack: list[_Open] = []
    where: dict[str, list[int]] = {}  # places of each tag in the stack
    parts: list[str] = []
    links = linked = at = drawings = 0
    skipped = ""  # embedded element outside an article that is not read

    def pop() -> None:
        where[stack.pop().tag].pop()

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not skipped:
            if stack and stack[-1].tag == "head" and raw.strip():
                pop()
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack[-1] if stack else None
                places.append(top)
                out.append(Block(text, linked, False, top is not None and top.article))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if skipped:
            if m.group(2) and tag == skipped:
                skipped = ""
            continue
        if tag in _EMBEDDED:
            if m.group(2):
                drawings -= tag == "svg" and drawings > 0
            elif not m.group(4).endswith("/"):
                if stack and stack[-1].article:
                    drawings += tag == "svg"
                else:
                    skipped = tag
        elif drawings and tag in ("text", "title", "desc"):
            parts.append(" ")
        elif tag == "a":
            links = 0 if m.group(2) else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            close()
            links = 0
            if m.group(2):
                if where.get(tag):
                    upto = where[tag][-1]
                    while len(stack) > upto:
                        pop()
            elif tag not in _VOID:
                while stack and (stack[-1].tag == "p" or (stack[-1].tag == "head" and tag != "title")):
                    pop()
                if tag == "li" and stack and stack[-1].tag == "li":
                    pop()
                if tag in ("article", "main"):
                    around = stack[-1] if stack else None
                    while around is not None and not around.holds:
                        around.holds = True
                        around = around.up
                where.setdefault(tag, []).append(len(stack))
                stack.append(_Open(tag, m.group(4), stack[-1] if stack else None))
    add(page[at:])
    close()
    for block, place in zip(out, places):
        block.furniture = place is not None and place.furniture()
    return out


def stop_share(text: str) -> float:
    """Stop words among the words of a text."""
    words = _INK.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def first_pass(b: Block) -> int:
    """The label of a block on its own: by link density, length and stop-word density; furniture is bad."""
    n = len(b.text)
    if b.furniture or b.linked / n > MOST_LINKS:
        return BAD
    if n < SHORT:
        return OPEN
    stops = stop_share(b.text)
    if stops >= MANY or (stops >= FEW and n > LONG):
        return GOOD
    return OPEN


def second_pass(blocks: list[Block], first: list[int]) -> list[int]:
    n = len(blocks)
    before, after = [None] * n, [None] * n  # (label, distance in blocks) of the nearest decided block outside furniture
    for out, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        label, far = None, 0
        for i in order:
            if blocks[i].furniture:
                continue
            far += 1
            if label is not None:
                out[i] = (label, far)
            if first[i] != OPEN:
                label, far = first[i], 0
    final = list(first)
    for i in range(n):
        if first[i] != OPEN:
            continue
        near = [x for x in (before[i], after[i]) if x]
        if not near:
            final[i] = BAD
        elif len({label for label, _ in near}) == 1:
            final[i] = near[0][0]
        else:
            some = len(blocks[i].text) >= SHORT and stop_share(blocks[i].text) >= FEW
            final[i] = GOOD if some or blocks[i].article else min(near, key=lambda x: (x[1], -x[0]))[0]
    if GOOD not in final:
        final = [GOOD if f == OPEN else x for f, x in zip(first, final)]
    return final


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    labels = second_pass(blocks, [first_pass(b) for b in blocks])
    return "\n\n".join(b.text for b, x in zip(blocks, labels) if x == GOOD)


def _extract(col: pa.Array) -> pa.Array:
    return pa.array([main_text(x.as_py()) for x in col], pa.string())


@by_value
def with_main_text(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of each whole page."""
    return df.withColumn(out, F.arrow_udf(_extract, returnType="string")(text_or_empty(html_col)))


def op8_html_blocks(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
