"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block element. Menus, headers, footers, forms and the like leave gaps of empty
lines; lines that are mostly links, or stand in an element named like an advert or a comment list, weigh nothing. Text
lengths are summed over sliding windows of lines: text begins where the sum surges and ends where it dives to nothing.
The stretches between are kept, with what else stands in the elements that hold them. Markup of the main part adds to
the weight of its lines and takes all weight from the others, unless these hold several times its text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideframe.llm.repeats import _batch

#: Lines of a window; the sum at which text surges; how often the text of the marked main part counts against that of
#: another stretch, which must be longer to count beside it.
WINDOW, SURGE, OUTWEIGH = 3, 80, 2
#: A line that is mostly links is text like others if no more than so many in a row stand between lines of text.
CITED = 2

#: Elements without an end, that part blocks, whose content is no markup, and that are page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
FURNITURE = frozenset(
    "head script style noscript template svg math canvas iframe object audio video nav aside footer form fieldset button select textarea input "
    "menu dialog noembed noframes xmp title".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
#: Words of classes and ids that name furniture, and words that may stand beside them without meaning more.
NAMED = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion cta banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead topbar toolbar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "signup login comment comments commentlist reply replies respond disqus discussion opinions share sharing social related recommended "
    "recommendations widget pagination pager tags skip copyright legal print search".split()
)
BESIDE = frozenset(
    "box list area section wrap wrapper container bar block links link form panel item items inner outer row col column unit slot group top bottom left "
    "right main site page post posts article articles user users reader readers global content body header text message messages icons buttons button "
    "thread feed cloud title".split()
)
#: Words that name furniture whatever stands beside them, but for those that say that it isn't this.
ALWAYS = frozenset("comments commentlist disqus sidebar newsletter cookies breadcrumb breadcrumbs pagination advert adverts advertisement".split())
ABOUT = frozenset("no not has have with without hide hidden show is non enable enabled disable disabled".split())
_MAIN = re.compile(r"(?<![a-z])(article|articlebody|article-body|post-content|entry-content|main-content|story-body|content-body)(?![a-z-])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_WHITE = re.compile(r"\s+")

#: What a line is: part of the main part, none, in a named advert or the like.
PLAIN, MARKED, NAMED_LINE = range(3)


class Line:
    __slots__ = ("parts", "linked", "kind", "holder", "kept")

    def __init__(self, kind: int, holder: int):
        self.parts: list[str] = []
        self.linked, self.kind, self.holder, self.kept = 0, kind, holder, ""


def tags(page: str) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, name (with / if it closes) and attributes of each tag; without a name for comments and the like.

    Each character is looked at a bounded number of times, whatever the markup: what isn't closed reaches to the next >
    or, without one, is text.
    """
    last, last_quote = page.rfind(">"), {q: page.rfind(q) for q in "\"'"}
    at = page.find("<")
    while 0 <= at < last:
        name = _NAME.match(page, at + 1)
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", ""
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", ""
        elif name:
            end = _PLAIN.match(page, name.end()).end()
            while end < last and page[end] != ">":
                quote = page[end]
                if last_quote[quote] <= end:  # never closed
                    end = page.find(">", name.end())
                    break
                end = _PLAIN.match(page, page.find(quote, end + 1) + 1).end()
            if end > last or page[end] != ">":
                end = page.find(">", name.end())
            yield at, end + 1, name[0], page[name.end() : end]
            end += 1
        elif page[at + 1] in "!?/":
            end = page.find(">", at) + 1
            yield at, end, "", ""
        else:
            end = at + 1
        at = page.find("<", end)


def _named(value: str) -> bool:
    """Whether one of the names in a class or id stands for furniture: a word for it, and else only words without weight; or
    one of the words that leave no doubt."""
    for name in value.split():
        own = {w for w in re.split(r"[^a-z]+", _CAMEL.sub(" ", name).lower()) if w}
        if own & NAMED and own <= NAMED | BESIDE or own & ALWAYS and not own & ABOUT:
            return True
    return False


def _looks(tag: str, attributes: str, inside: bool) -> int | None:
    """What an element's markup says of its text; None for page furniture."""
    if tag in FURNITURE or tag == "header" and not inside:  # an article's own header holds its title
        return None
    if tag in ("article", "main"):
        return MARKED
    out = PLAIN
    for name, value in _ATTRIBUTE.findall(attributes) if attributes and tag not in ("html", "body") else ():
        name, value = name.lower(), value.strip("\"'")
        low = value.lower()
        if name == "hidden" or name == "aria-hidden" and low == "true" or name == "role" and low in _ROLES:
            return None
        if name == "role" and low == "main" or name == "itemprop" and low == "articlebody":
            out = MARKED
        elif name in ("class", "id"):
            if _named(value):
                return NAMED_LINE
            if _MAIN.search(low) and "comment" not in low:
                out = MARKED
    return out


def lines_of(page: str) -> list[Line]:
    """The lines of a page in order; page furniture leaves a gap of empty lines."""
    #: element, in furniture, kind of its lines, number of the element that holds them
    stack: list[tuple[str, bool, int, int]] = [("", False, PLAIN, 0)]
    opened: Counter[str] = Counter()
    lines = [Line(PLAIN, 0)]
    links = at = holders = 0

    def text(raw: str) -> None:
        if raw and not stack[-1][1]:
            plain = html.unescape(raw)
            lines[-1].parts.append(plain)
            if links:
                lines[-1].linked += len(_WHITE.sub("", plain))

    def new_line(gap: bool = False) -> None:
        for _ in range(WINDOW + 1 if gap else 1):
            if gap or lines[-1].parts:
                lines.append(Line(*stack[-1][2:]))
            else:
                lines[-1].kind, lines[-1].holder = stack[-1][2:]

    def pop() -> str:
        nonlocal links
        tag, inside, *_ = stack.pop()
        opened[tag] -= 1
        links -= tag == "a"
        if inside and not stack[-1][1]:
            new_line(gap=True)
        return tag

    for start, end, name, attributes in tags(page):
        if start < at:  # within an element whose content is no markup
            continue
        text(page[at:start])
        at = end
        closing, tag = name[:1] == "/", name.lstrip("/").lower()
        if not tag:
            continue
        if closing:
            if opened[tag] > 0:
                while pop() != tag:
                    pass
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            if stack[-1][0] == "p" and tag in BLOCK:
                pop()  # a block ends a paragraph
            if tag in ("li", "dt", "dd", "option", "tr", "td", "th") and stack[-1][0] == tag:
                pop()
            _, inside, kind, holder = stack[-1]
            looks = _looks(tag, attributes, kind == MARKED)
            if tag in BLOCK and tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "body", "html"):
                holders += 1
                holder = holders
            kind = kind if looks is None or looks == PLAIN or kind == NAMED_LINE else looks
            stack.append((tag, inside or looks is None, kind, holder))
            opened[tag] += 1
            links += tag == "a"
        if tag in BLOCK:
            new_line()
        elif tag == "br":
            text(" ")
        if tag in RAW and not closing and stack[-1][0] == tag:
            closed = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = closed.end() if closed else len(page)
            pop()
    text(page[at:])
    return lines


def _cited(lines: list[Line]) -> list[bool]:
    """Whether a line that is mostly links stands, alone or with one other, between lines of text of the same element: a
    sentence that is a reference, not an entry of a menu or a list of pages."""
    full = [i for i, x in enumerate(lines) if x.kept]
    heavy = [lines[i].linked > 0.5 * len(lines[i].kept) for i in full]
    out, k = [False] * len(lines), 0
    while k < len(full):
        if not heavy[k]:
            k += 1
            continue
        end = k
        while end < len(full) and heavy[end]:
            end += 1
        if 0 < k and end < len(full) and end - k <= CITED:
            one, two = lines[full[k - 1]], lines[full[end]]
            together = full[end] - full[k - 1] <= end - k + WINDOW  # no gap of furniture between them
            same = {x.holder for x in (one, two, *[lines[i] for i in full[k:end]])}
            if together and len(same) == 1 and min(len(one.kept), len(two.kept)) >= SURGE // 2:
                for i in full[k:end]:
                    out[i] = True
        k = end
    return out


def weights(lines: list[Line]) -> list[int]:
    """What each line adds to the sums: its length, with the surge besides in the main part that the page marks.

    Beside a marked part other stretches only count if they hold more text than OUTWEIGH times that part.
    """
    for line in lines:
        line.kept = _WHITE.sub(" ", "".join(line.parts)).strip()
    cited = _cited(lines)
    own = [0 if x.kind == NAMED_LINE or x.linked > 0.5 * len(x.kept) and not c else len(x.kept) for x, c in zip(lines, cited)]
    if not any(own):  # nothing but links or named furniture: then the names are wrong
        own = [len(x.kept) if x.kind == NAMED_LINE and x.linked <= 0.5 * len(x.kept) else 0 for x in lines]
    marked = sum(n for n, x in zip(own, lines) if x.kind == MARKED)
    if not marked:
        return own
    other = [0 if x.kind == MARKED else n for n, x in zip(own, lines)]
    longest = {i for a, b, surged in stretches(other) if surged and sum(other[a:b]) > OUTWEIGH * marked for i in range(a, b)}
    return [n and n + SURGE if x.kind == MARKED else n if i in longest else 0 for i, (n, x) in enumerate(zip(own, lines))]


def stretches(own: list[int], window: int = WINDOW) -> list[tuple[int, int, bool]]:
    """The stretches of lines between sums of nothing: first line, last one (exclusive), and whether the sums surge there.

    A sum is of `window` lines that end with the one at hand.
    """
    out: list[tuple[int, int, bool]] = []
    total, start, surged, last = 0, None, False, 0
    for i, n in enumerate(own):
        total += n - (own[i - window] if i >= window else 0)
        if not total:
            if start is not None:
                out.append((start, last + 1, surged))
            start, surged = None, False
            continue
        if n:
            start, last = i if start is None else start, i
        surged = surged or total >= SURGE
    if start is not None:
        out.append((start, last + 1, surged))
    return out


def main_text(page: str | None) -> str:
    """The blocks of the main text, two line ends between them. Empty if the page has no text but furniture."""
    lines = lines_of(page or "")
    own = weights(lines)
    spans = stretches(own)
    if spans and not any(surged for *_, surged in spans):  # a short text is the longest there is
        top = max(range(len(spans)), key=lambda k: sum(own[spans[k][0] : spans[k][1]]))
        spans[top] = (*spans[top][:2], True)
    holders = {lines[i].holder for a, b, surged in spans if surged for i in range(a, b) if own[i]} - {0}
    kept = [i for a, b, surged in spans for i in range(a, b) if own[i] and (surged or lines[i].holder in holders)]
    return "\n\n".join(lines[i].kept for i in kept)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(df: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page. Null html counts as empty and gives an empty text; null ids and urls
    and repeated rows are kept as they are; a page of any length, well-formed or not, is read whole, in time that its
    length is in proportion to; an empty df gives no rows; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield _batch(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, map(len, texts)), _OUT)

    return df.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
