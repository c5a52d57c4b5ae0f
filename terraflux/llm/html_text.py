"""HTML main text by two-pass block rules.

A page is cut into blocks at its block-level tags. The first pass classifies each block on its own: link density, length
and the share of stop words, and the container that it stands in. Blocks too short to tell, or with few of the known stop
words, stay undecided; in the second pass they take the label of the nearest decided neighbours, those in the same
container first. Containers are told by their element or by a word of their class; what a class alone says does not
hold for an article within, nor, on a page that would come out empty, for long blocks full of stop words. What stands
under a heading such as "3 comments" is no main text, nor is what stands beside an article that holds most good text.
Each page is one row and is worked on alone, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import table

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his if in is it its not of on or she so that the their they this to was we were which will with you
    als am an auch auf aus bei das dem den der des die ein eine einem einen einer es für hat ich im in ist mit nach nicht noch oder sich sie sind so über um und von war wie zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne nous ou où par pas plus pour qu que qui sa sans se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este ha hay la las le lo los más me mi no o para pero por que se sin sobre su sus también un una y ya""".split()
)
LONG, SHORT = 200, 70
#: Pages whose texts a worker hands on at a time.
SLICE = 64
MANY_STOPS, SOME_STOPS = 0.30, 0.15
MANY_LINKS = 0.33

#: Elements whose content is no text of the page; the first run to the end of the page if they are not closed, of the others
#: the tag alone is then left out. A head holds no others with text, so its end, which may be left out, is not sought.
RAW, HIDDEN = "script|style|textarea|title", "noscript|template|svg|math|iframe|object|canvas|audio|video|select|button"
#: Elements that hold other blocks, and those of them whose blocks are never main text. A form may hold a whole page.
CONTAINERS = frozenset("html body main article section div nav header footer aside form fieldset dialog menu ul ol dl table thead tbody tfoot tr figure blockquote details center".split())
OUTSIDE = frozenset("nav footer aside fieldset dialog menu".split())
INSIDE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = CONTAINERS | HEADINGS | frozenset("p li dt dd td th caption figcaption legend summary pre address hr option".split())
#: Words of a class, id or role that say the same: the last word of a name, or the first one before words such as "box".
MARKS = frozenset(
    """ad ads adv advert advertisement advertising adverts sponsor sponsored promo promotion banner sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs
    footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup comment comments replies disqus respond discussion utterances giscus isso reviews ratings message messages guestbook
    related recommended share sharing social pagination pager search login toc contentinfo complementary dialog""".split()
)
#: Those of them that templates also put around an article, and words that a mark may have after it or that undo it before it.
LAYOUT = frozenset("banner sidebar aside widget menu nav navbar navigation masthead modal overlay search login toc form".split())
FILLERS = frozenset(
    """container box wrapper wrap bar list lists item items link links section sections area block blocks body text content contents inner outer top bottom left right head header title
    unit slot space holder panel pane group row column button buttons form field fields icon icons image main primary secondary site global desktop mobile thread tree meta author count post posts
    article articles story stories news policy message""".split()
)
UNDONE = frozenset("with has no not without".split())

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+>(?:(?<=/>)|.*?(?:</(?P=raw)\s*+>|\Z))|<(?P<hidden>{HIDDEN})(?=[\s/>])[^>]*+>"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?a-z][^>]*+(?:>|\Z)",
    re.I | re.S,
)
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


#: Headings above what readers say. They mute what follows in their container: to its end or, in an article, main or body,
#: to the next heading of their level.
_COMMENTS = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user|leser|latest|all|recent)s?['’]?\s+)?(?:comments?|kommentare?|leserkommentare|commentaires?|comentarios?)(?:\s*[(:].{0,12})?\W*(?:\d+\W*)?"
    r"|\W*\d+\s+(?:responses?|replies|thoughts|antworten|réponses|respuestas)\b.{0,80}"
    r"|\W*(?:leave|post|write|add|join|schreibe?n?|laisse[rz]?|deja|escribe)\s.{0,20}\b(?:reply|comments?|response|discussion|conversation|kommentar|commentaire|réponse|comentario|respuesta)\b.{0,40}",
    re.I,
)


@dataclass
class Open:
    """A container that is open. content: within article or main. outside: outside the main text (1: layout, 2: other
    class; an article or main within resets both; 3: surely). headers: open header elements, itself included. muted: the
    level of the heading of comments that its blocks stand under, 0 for none."""

    name: str
    number: int = 0
    content: bool = False
    outside: int = 0
    headers: int = 0
    muted: int = 0


@dataclass
class Block:
    text: str
    linked: int
    container: int
    content: bool
    outside: bool
    heading: bool
    layout: bool  # outside by a class of the page's layout alone


def _mark(name: str) -> set[str]:
    """The marks that a class, id or role is made of; none if it is no mark as a whole."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts:
        return set()
    last = parts[-1] in MARKS and (len(parts) == 1 or parts[-2] not in UNDONE)
    first = parts[0] in MARKS and all(p in MARKS or p in FILLERS or len(p) < 3 for p in parts[1:])
    return MARKS.intersection(parts) if last or first else set()


def _marks(attrs: str) -> set[str]:
    """The marks of an element; "hidden" if it is not shown."""
    if "=" not in attrs and "hidden" not in attrs:
        return set()
    if _UNSEEN.search(attrs):
        return {"hidden"}
    return set().union(*[_mark(name) for m in _MARKED.finditer(attrs) for name in (m[1] or m[2] or m[3] or "").split()])


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    stack = [Open("")]
    places: dict[str, list[int]] = {}  # of each element's open ones in the stack
    parts: list[str] = []
    linked, in_link, number, heading, off = 0, False, 0, 0, False
    last_end: dict[str, int] = {}

    def ends_after(name: str, at: int) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(rf"</{name}\s*>", page, re.I)), default=-1)
        return last_end[name] >= at

    def close() -> None:
        nonlocal linked, in_link, heading, off
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            if heading and len(text) < 120 and _COMMENTS.fullmatch(text):
                top.muted = top.muted or heading
            elif heading and heading <= top.muted and top.name in ("", "html", "body", "article", "main"):
                top.muted = 0
            header = top.headers > 0 and not (top.content and heading)
            surely = off or header or top.muted > 0
            out.append(Block(text, min(linked, len(text)), top.number, top.content, top.outside > 0 or surely, heading > 0, top.outside == 1 and not surely))
        parts.clear()
        linked, in_link, heading, off = 0, False, 0, False

    def leave(depth: int) -> None:
        """Closes all containers from a place in the stack on."""
        while len(stack) > depth:
            places[stack.pop().name].pop()

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(" ".join(text.split()))

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if hidden := m["hidden"]:
            if not m[0].endswith("/>") and ends_after(hidden.lower(), at):
                at = re.compile(rf"</{hidden}\s*>", re.I).search(page, at).end()
            continue
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        name, ends = name.lower(), bool(m["end"])
        if name == "a":
            in_link = not ends
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            close()
            if name in CONTAINERS:
                if ends:
                    if places.get(name):
                        leave(places[name][-1])
                elif not m["attrs"].rstrip().endswith("/"):
                    if name in INSIDE:  # an element that is not closed any more ends where an article begins
                        unclosed = [places[x][0] for x in (*OUTSIDE, "header") if places.get(x) and not ends_after(x, at)]
                        if unclosed:
                            leave(min(unclosed))
                    number += 1
                    top = stack[-1]
                    outside = 3 if top.muted else top.outside
                    marks = set() if name in ("html", "body", "article", "main") else _marks(m["attrs"])
                    if name in OUTSIDE or (marks and _marks(_CLASS.sub("", m["attrs"]))):
                        outside = 3
                    elif marks:
                        outside = max(outside, 1 if marks <= LAYOUT else 2)
                    elif name == "form":
                        outside = max(outside, 1)
                    elif outside in (1, 2) and name in INSIDE and not _marks(m["attrs"]):
                        outside = 0
                    places.setdefault(name, []).append(len(stack))
                    stack.append(Open(name, number, top.content or name in INSIDE, outside, top.headers + (name == "header")))
            elif not ends:
                heading = int(name[1]) if name in HEADINGS else 0
                off = bool(_marks(m["attrs"]))
    if at < len(page):
        add(page[at:])
    close()
    return out


def _first_pass(block: Block) -> str:
    n = len(block.text)
    if block.outside or block.linked / n > MANY_LINKS:
        return "bad"
    words = [w.strip(".,;:!?\"'()").lower() for w in block.text.split()]
    stops = sum(w in STOP_WORDS for w in words) / len(words)
    if n < SHORT:
        return "short"
    if stops >= MANY_STOPS:
        return "good" if n > LONG else "near"
    return "near" if stops >= SOME_STOPS else "short"


def _second_pass(found: list[Block], labels: list[str]) -> list[bool]:
    """Near-good blocks are decided where no bad text stands on both sides; short ones take over the nearest labels."""
    decided = [(i, label == "good") for i, label in enumerate(labels) if label in ("good", "bad")]
    any_good = any(good for _, good in decided)
    any_content = any(b.content and not b.outside for b in found)
    groups: dict[object, list[int]] = {}
    for i, _ in decided:
        groups.setdefault(found[i].container, []).append(i)
        if not found[i].outside:
            groups.setdefault(("content", found[i].content), []).append(i)
    keep = []
    for i, (block, label) in enumerate(zip(found, labels)):
        if label in ("good", "bad"):
            keep.append(label == "good")
            continue
        near = groups.get(block.container) or groups.get(("content", block.content)) or []
        at = bisect(near, i)
        before = near[at - 1] if at else None
        after = near[at] if at < len(near) else None
        own = {labels[j] == "good" for j in (before, after) if j is not None}
        if not own:
            keep.append(block.content or (not any_good and not any_content))
        elif len(own) == 1:
            keep.append(own.pop())
        elif label == "near" or block.content:
            keep.append(True)
        elif block.heading:
            keep.append(labels[after] == "good")
        else:
            keep.append(labels[before if i - before <= after - i else after] == "good")
    return keep


def main_text(page: str | None) -> str:
    """The main text: blocks joined by an empty line; empty for a null page and one without main text."""
    found = blocks(page or "")
    labels = [_first_pass(b) for b in found]
    good = {inside: sum(len(b.text) for b, label in zip(found, labels) if label == "good" and b.content == inside) for inside in (True, False)}
    if good[True] > good[False]:  # the page marks its article, and most of its good text stands there: nothing else is main text
        labels = [label if b.content else "bad" for b, label in zip(found, labels)]
    keep = _second_pass(found, labels)
    if not any(keep) and any(b.layout for b in found):
        found = [replace(b, outside=b.outside and not b.layout) for b in found]
        keep = [_first_pass(b) == "good" for b in found]
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars. Null html is empty; nulls in page_id and url, repeated rows and
    pages of any length are kept as they are. Other columns are ignored; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):  # a batch of long pages is read some at a time
                own = batch.slice(begin, SLICE)
                texts = pa.array((main_text(page.as_py()) for page in own.column(2)), pa.string())  # one page at a time is a Python string
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), texts], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    read = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html").mapInArrow(run, "page_id string, url string, text string")
    return read.select(F.col("page_id").cast(kind), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
