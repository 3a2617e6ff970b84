"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides what it can: by the
element a block lies in (a menu, a footer, or an article if it holds as much text as the rules
accept outside of it), else by link density, length and the share of stop words, which are known
of four languages; pages in others are judged without them. Blocks that are short or in between
stay open; in the second pass each takes the label of the nearest decided block. On a page
without any content block the open ones are content.
"""

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skytally.llm.common import boxed

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe)"
    r"(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_WORDS = re.compile(r"\w+")

# Names of HTML elements. Fixed values.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr"
    # Containers of formulas, drawings and fallback text
    " canvas math noscript object svg"
    " annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom"
    " mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none"
    " semantics circle defs ellipse g line path polygon polyline rect tspan use".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CONTENT_TAGS = frozenset(["article", "main"])
_OTHER_TAGS = frozenset(
    "aside button datalist dialog fieldset footer form header label legend menu nav optgroup option output select".split()
)
_CLOSED_BY_BLOCKS = frozenset("p li dt dd option".split())

# Words in class, id or role that tell what an element is for. Fixed values.
_OTHER_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments"
    " complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus footer form"
    " gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain"
    " pager pagination popup promo promotion promoted recommended related replies reply respond search share"
    " sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toc toolbar topbar"
    " widget widgets".split()
)
_CONTENT_NAME = re.compile(r"(?:article|entry|main|post|story|page)[-_]?(?:body|content|text)|articlebody", re.I)

# Stop words of the languages read. Fixed values.
STOP_WORDS = frozenset(
    # English
    "a about after all also an and are as at be been but by can for from had has have he her his if in into is it"
    " its more not of on one or other she so some than that the their them then there these they this to was we"
    " were what when which who will with would you your"
    # German
    " aber als am auch auf aus bei bin bis das dass dem den der des die du durch ein eine einem einen einer er es"
    " für hat ich im in ist mit nach nicht noch nur oder sein sich sie sind so und unter vom von vor war was wie"
    " wird wir zu zum zur über"
    # French
    " au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me même mon ne"
    " nous on ou par pas pour qu que qui sa se ses son sur ta te tu un une vos votre vous"
    # Spanish
    " al como con cuando de del desde donde el ella ellos en entre era es esta este fue ha hay la las lo los más"
    " me mi muy no nos o para pero por que se si sin sobre son su sus también te todo un una y ya".split()
)


@dataclass
class Rules:
    """Thresholds of the first pass. Lengths are in characters."""

    link_density: float = 0.33  # above: not content
    short: int = 70  # below: open
    long: int = 200  # from here on content even with links, if there are enough stop words
    low_stop: float = 0.15  # below, a block that is not short is not content, or of another language
    high_stop: float = 0.25


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    links: int
    zone: bool | None  # in an element for content, for something else, or neither
    headline: bool = False  # in an h1, and no link


def _zone_of(name: str, rest: str, within):
    """Zone of an element in one of zone ``within``; "form" is a form's own kind of False."""
    attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest else {}
    hints = " ".join(attributes.get(k, "") for k in ("class", "id", "role", "itemprop"))
    parts = {x.lower() for x in _NAME_PARTS.findall(hints)} if hints else ()
    content = name in _CONTENT_TAGS or "main" in attributes.get("role", "").split()
    if within is False or within == "form" and not content:
        return within
    style = attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    if hidden or "display:none" in style or name not in ("html", "body") and _OTHER_NAMES & set(parts):
        return False
    if name == "template" and "shadowrootmode" not in attributes:
        return False  # never shown as it stands
    if name in _OTHER_TAGS:
        return "form" if name == "form" else False
    if content or hints and _CONTENT_NAME.search(hints):
        return True
    return within


def blocks(page: str) -> list[Block]:
    """The blocks of a page that hold any text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, object]] = []  # open elements and their zones
    text: list[tuple[str, bool]] = []  # pieces of the block, and whether they are linked
    links = in_link = 0

    def zone():
        return stack[-1][1] if stack else None

    def flush():
        nonlocal links
        if text:
            whole = " ".join(html.unescape("".join(t for t, _ in text)).split())
            if whole:
                linked = " ".join(html.unescape("".join(t for t, own in text if own)).split())
                now = zone()
                headline = not links and any(name == "h1" for name, _ in stack[-3:])
                found.append(Block(whole, len(linked), links, False if now == "form" else now, headline))
            text.clear()
        links = 0

    at = 0
    for match in _TOKEN.finditer(page):
        if match.start() > at:
            text.append((page[at : match.start()], in_link > 0))
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            text.append((" ", False))
            continue
        if name == "a":
            in_link = 0 if match["end"] else 1
            links += not match["end"]
        elif name not in _INLINE:
            flush()
            if stack and stack[-1][0] in _CLOSED_BY_BLOCKS and not match["end"]:
                if name in (stack[-1][0], "p") or stack[-1][0] == "p":
                    stack.pop()
        if match["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if zone() != (stack[depth - 1][1] if depth else None):
                        flush()
                    del stack[depth:]
                    break
        elif name not in _VOID and not match["rest"].endswith("/") and (name not in _INLINE or match["rest"]):
            own = _zone_of(name, match["rest"], zone())
            if name not in _INLINE or own != zone() and name != "a":
                if own != zone():
                    flush()
                stack.append((name, own))
    if at < len(page):
        text.append((page[at:], in_link > 0))
    flush()
    return found


def _stop_share(text: str) -> float:
    words = _WORDS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _foreign(block: Block) -> bool:
    """Whether most letters are of a script in which none of the stop words is written."""
    letters = [c for c in block.text if c.isalpha()]
    return sum(c > "\u024f" for c in letters) * 2 > len(letters)


def by_rules(block: Block, known_language: bool, rules: Rules) -> bool | None:
    """Whether a block is content by link density, length and stop words; None where that is
    open. In other languages than those of the stop words, length and links decide."""
    density = block.linked / len(block.text)
    if density > rules.link_density:
        return False
    if len(block.text) < rules.short:
        return False if block.links else None
    if not known_language or _foreign(block):
        if not _WORDS.search(block.text):
            return False
        return True if not block.links or len(block.text) >= rules.long else None
    stop = _stop_share(block.text)
    if stop < rules.low_stop:
        return False
    return True if stop >= rules.high_stop and (len(block.text) >= rules.long or not block.links) else None


def _language_known(found: list[Block], rules: Rules) -> bool:
    """Whether most text of the blocks that may be content has stop words."""
    known = other = 0
    for block in found:
        if block.zone is not False and len(block.text) >= rules.short and (
            block.linked <= rules.link_density * len(block.text)
        ):
            if _stop_share(block.text) >= rules.low_stop:
                known += len(block.text)
            else:
                other += len(block.text)
    return known >= other


def _link_list(block: Block) -> bool:
    return block.links > 1 and block.linked > 0.5 * len(block.text)


def first_pass(found: list[Block], rules: Rules) -> list[bool | None]:
    """Whether each block of a page is content; None where that is open."""
    known = _language_known(found, rules)
    judged = [None if b.zone is False else by_rules(b, known, rules) for b in found]
    in_zone = [b.zone is True and not _link_list(b) for b in found]
    inside = sum(len(b.text) for b, own in zip(found, in_zone) if own)
    outside = sum(len(b.text) for b, label in zip(found, judged) if b.zone is None and label)
    labels: list[bool | None] = []
    for block, own, label in zip(found, in_zone, judged):
        if block.zone is False:
            labels.append(False)
        elif inside and inside >= outside:
            # The element holds most of the content: what is in it stays, the rest goes.
            labels.append(own)
        elif block.zone is True:
            labels.append(False if label is False else own)
        else:
            labels.append(label)
    if inside and inside >= outside:
        # But for the headline and the lead that stand right before it.
        at = in_zone.index(True) - 1
        while at >= 0 and found[at].zone is None and (judged[at] or found[at].headline):
            labels[at] = True
            at -= 1
    if True not in labels:
        # Nothing speaks for any block: then what nothing speaks against is content.
        open_ = [i for i, label in enumerate(labels) if label is None]
        for i in [i for i in open_ if len(found[i].text) >= rules.short] or open_:
            labels[i] = True
    return labels


def second_pass(labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided one, of two the one before. Without
    any decided block all are content."""
    decided = [i for i, label in enumerate(labels) if label is not None]
    if not decided:
        return [True] * len(labels)
    out, at = [], 0
    for i, label in enumerate(labels):
        while at + 1 < len(decided) and decided[at + 1] <= i:
            at += 1
        if label is None:
            near = [d for d in decided[at : at + 2]]
            label = labels[min(near, key=lambda d: (abs(d - i), d > i))]
        out.append(label)
    return out


def main_text(page: str | None, rules: Rules = Rules()) -> tuple[str, int, int]:
    """The main text, the number of blocks and how many of them it has."""
    found = blocks(page or "")
    labels = second_pass(first_pass(found, rules))
    kept = [b.text for b, good in zip(found, labels) if good]
    return " ".join(kept), len(found), len(kept)


def extract(pages: DataFrame, rules: Rules = Rules(), page_html="html") -> DataFrame:
    """Every page with its main text.

    Columns: page (struct of the columns but the html), text, n_blocks, n_kept. A null html is
    empty; a page without text has an empty one. Scripts, styles, comments, text areas, titles and
    frames that are never closed run to the end. Formulas, drawings and fallback text count as text.
    An empty table gives no rows.
    """
    rows = boxed(pages, page_html)
    schema = T.StructType(
        [
            T.StructField("page", rows.schema["doc"].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_blocks", T.IntegerType()),
            T.StructField("n_kept", T.IntegerType()),
        ]
    )

    def run(batches):
        for batch in batches:
            found = [main_text(p, rules) for p in batch.column("text").to_pylist()]
            columns = list(zip(*found)) or [()] * 3
            kinds = [pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
