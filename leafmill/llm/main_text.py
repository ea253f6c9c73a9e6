"""Main text of web pages: the best contiguous stretch of words and tags.

A page is a sequence of words and tags. Every word scores by where it stands (the nearest
enclosing blocks), every tag scores negative; the main text is the stretch with the largest
total, found in one scan. The weights are log-odds learned from pages that label themselves:
those whose markup has one ``article`` or ``main`` element, within which words are content
and outside of which they are not. Elements that are never text (scripts, styles, forms, hidden blocks and
the like), menus, headers, footers and sidebars marked by their element or role, and blocks whose
words are seldom content are left out; links stay with the block around them.

A block's name (a whole word of its class or id) is one more feature with a learned weight: what
stands under it counts as a box beside the text only while labelled pages do not speak against it,
an ``article`` or ``main`` within it ends it, and names that would take more than half of the words
have no say, as they belong to a wrapper. Only names of reader comments are fixed.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from leafmill.llm.tables import small_batches

# Elements by their role in HTML.
SILENT = {
    "script", "style", "noscript", "template", "svg", "math", "canvas", "iframe", "object",
    "form", "button", "select", "textarea", "title", "head",
}
CHROME = {"nav", "header", "footer", "aside", "menu", "dialog"}
RAW = {"script", "style", "textarea", "title"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
# Opening one of these ends an open paragraph.
ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol",
    "p", "pre", "section", "table", "ul",
}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"}
# Names of boxes beside the text, as whole words of a class or id, from which learning starts.
NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "consent", "cookie",
    "cookie-banner", "cookie-consent", "cookie-notice", "cookies", "copyright", "footer", "gdpr", "header", "login",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "related-posts", "search", "share",
    "share-buttons", "sharing", "side", "sidebar", "signup", "site-footer", "site-header", "social", "social-links",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENTS = {
    "comment", "comments", "comment-list", "commentlist", "comments-area", "comments-section", "disqus",
    "disqus_thread", "replies", "reply", "respond",
}
HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
LABELS = ("article", "main")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Weights before anything is learned, counted as this many words.
PRIOR_WORDS = 50.0
NAME_PRIOR = -2.0
TAG_WEIGHT = -0.2
LABEL_PAGES = 4000
# Words from which on the text of a block is long.
LONG_WORDS = 20


@dataclass
class Weights:
    """Log-odds of words by place, and the score of a tag."""

    places: dict[str, float] = field(default_factory=dict)
    tag: float = TAG_WEIGHT
    names: dict[str, float] = field(default_factory=dict)

    def name(self, name: str) -> float:
        return NAME_PRIOR if name in COMMENTS else self.names.get(name, NAME_PRIOR)

    def word(self, place: str) -> float:
        known = self.places.get(place)
        if known is None and "~" in place.split(">", 1)[0]:
            known = self.places.get(any_block(place))
        return known if known is not None else prior(place)


def prior(place: str) -> float:
    """The weight of words in a place that no labelled page has."""
    return -2.0 if place.startswith("-") or place.endswith(" a") else 1.0


def block_names(place: str) -> list[str]:
    """Names under which all words of a block count, those of its links too.

    On pages without a label also one that leaves out whether the text is long.
    """
    landmark, block = place.removesuffix(" a").split(">", 1)
    names = [f"={landmark}>{block}"]
    if "~" in landmark:
        names.append(f"={landmark.split('~')[0]}~>{block}")
    return names


@dataclass
class Part:
    """A run of text in one place: its words' place, the tags before it, its label, and the name
    of the nearest box around it that has one."""

    text: str
    place: str
    tags: int
    inside: bool
    silent: bool
    boxed: bool
    name: str = ""


@dataclass
class Open:
    """An open element, with all that its ancestors mean for the text in it."""

    name: str
    block: str = ""
    linked: bool = False
    landmark: str = ""
    silent: bool = False
    boxed: bool = False
    inside: bool = False
    box_name: str = ""
    # Where the paragraph and the list item are that would end here.
    paragraph: int | None = None
    item: int | None = None


def boxes_settled(parts: list[Part], weights: Weights) -> list[Part]:
    """The parts, boxed also where a name says so; see the module's text."""
    named = [p for p in parts if p.name and not p.boxed and not p.silent and weights.name(p.name) < 0]
    if not named:
        return parts
    labelled = any(p.inside for p in parts)
    words = [len(p.text.split()) for p in parts]
    within = sum(n for p, n in zip(parts, words, strict=True) if (p.inside or not labelled) and not (p.silent or p.boxed))
    taken = sum(len(p.text.split()) for p in named if p.name not in COMMENTS and (p.inside or not labelled))
    wrapper = 2 * taken > within
    chosen = {id(p) for p in named if p.name in COMMENTS or not wrapper}
    return [replace(p, boxed=True, place="-" + p.place) if id(p) in chosen else p for p in parts]


def unlabelled(parts: list[Part]) -> list[Part]:
    """The parts with places that do not tell of landmarks, as for pages without a label.

    Such a place is the block and its class, whether it is a link, and whether the text
    between the block tags around it is long.
    """
    out: list[Part] = []
    at = 0
    while at < len(parts):
        end = at
        while end < len(parts) and parts[end].text != " ":
            end += 1
        words = sum(len(p.text.split()) for p in parts[at:end] if not p.silent)
        size = "~long" if words >= LONG_WORDS else "~short"
        for p in parts[at:end]:
            mark = "-" if p.boxed else ""
            out.append(replace(p, place=f"{mark}{size}>{p.place.split('>', 1)[1]}"))
        out += parts[end : end + 1]
        at = end + 1
    return out


def any_block(place: str) -> str:
    """The place without its block and class: what is known of blocks not seen before."""
    return f"{place.split('>', 1)[0]}>*{' a' if place.endswith(' a') else ''}"


def _attributes(rest: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}


def _opened(name: str, given: dict[str, str], above: Open, place: int) -> Open:
    """The state within a new element at that place of the stack."""
    block_level = name not in INLINE
    role = given.get("role", "").strip().lower()
    words = [w for k in ("class", "id") for w in given.get(k, "").lower().split()] if block_level else []
    about_comments = next((w for w in words if w in COMMENTS), "")
    label = (name in LABELS or role in LABELS) and not about_comments
    header_of_text = name == "header" and above.inside
    chrome = (name in CHROME or role in CHROME_ROLES) and not header_of_text and block_level
    own_name = about_comments or next((w for w in words if w in NAMES), "")
    hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or HIDDEN.search(given.get("style", ""))
    now = Open(
        name,
        block=f"{name}.{given.get('class', '').lower()}" if block_level and name != "a" else above.block,
        linked=above.linked or name == "a",
        landmark=name if name in CHROME or name in LABELS else role if label else above.landmark,
        silent=above.silent or name in SILENT or bool(hidden),
        boxed=False if label else above.boxed or chrome,
        inside=above.inside or label,
        box_name="" if label else own_name or above.box_name,
        paragraph=above.paragraph if not block_level else None,
        item=None if name in ("ul", "ol", "menu") else above.item,
    )
    if name == "p":
        now.paragraph = place
    if name == "li":
        now.item = place
    return now


def parts_of(page: str) -> list[Part]:
    """Split a page into runs of text; markup is gone but character references stay.

    The place of a run is the innermost block element with its class, under the landmark
    around it, and whether it is a link; ``-`` in front marks an element or role that is
    no content. A block's end leaves a blank run. Time grows with the page's length alone: an open
    element knows what all those around it mean, and an end tag without its start costs nothing.
    """
    out: list[Part] = []
    stack = [Open("")]
    counts: dict[str, int] = {}
    tags = 0
    at = 0

    def text(upto: int) -> None:
        nonlocal tags
        if upto > at:
            now = stack[-1]
            where = f"{'-' if now.boxed else ''}{now.landmark}>{now.block}{' a' if now.linked else ''}"
            out.append(Part(page[at:upto], where, tags, now.inside, now.silent, now.boxed, now.box_name))
            tags = 0

    def block_end() -> None:
        if out and out[-1].text != " ":
            out.append(Part(" ", "", 0, False, False, False))

    def close(place: int) -> None:
        for gone in stack[place:]:
            counts[gone.name] -= 1
        del stack[place:]

    while found := TOKEN.search(page, at):
        name = found["name"]
        text(found.start())
        at = found.end()
        if name is None:
            continue
        name = name.lower()
        tags += 1
        if name not in INLINE:
            block_end()
        if found["close"]:
            if counts.get(name):
                place = len(stack) - 1
                while stack[place].name != name:
                    place -= 1
                close(place)
            continue
        if name in ENDS_P and stack[-1].paragraph is not None:
            close(stack[-1].paragraph)
        if name == "li" and stack[-1].item is not None:
            close(stack[-1].item)
        if name not in VOID and not found["rest"].endswith("/"):
            stack.append(_opened(name, _attributes(found["rest"]), stack[-1], len(stack)))
            counts[name] = counts.get(name, 0) + 1
            if name in RAW:
                # Nothing but its own end counts within; without one the rest is its own.
                end = RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
    text(len(page))
    return out


def best_stretch(parts: list[Part], weights: Weights) -> tuple[int, int]:
    """Bounds of the contiguous parts with the largest score; (0, 0) if none is positive.

    Within one run all words score alike, so whole runs are best; one step per run. Of
    equal scores the earliest and then shortest stretch is taken. Boxes within a labelled
    element, and what is never text, leave the score as it is.
    """
    best, best_bounds = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, part in enumerate(parts):
        if part.silent or (part.boxed and part.inside):
            continue
        total += part.tags * weights.tag
        if total <= 0:
            total, start = 0.0, i
        total += len(part.text.split()) * weights.word(part.place)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_bounds = total, (start, i + 1)
    return best_bounds


def main_text(page: str | None, weights: Weights) -> str:
    """The main text of a page: blocks in order, white space as single blanks."""
    parts = boxes_settled(parts_of(page or ""), weights)
    if not any(p.inside for p in parts):
        parts = unlabelled(parts)
    a, b = best_stretch(parts, weights)
    # A block that the stretch cuts, as at a link, is taken whole.
    while a < b and a and " " not in (parts[a].text, parts[a - 1].text):
        a -= 1
    while a < b < len(parts) and " " not in (parts[b - 1].text, parts[b].text):
        b += 1
    kept = [
        p.text
        for p in parts[a:b]
        if p.text == " " or not (p.silent or p.boxed or max(map(weights.word, block_names(p.place))) < 0)
    ]
    return " ".join(html.unescape("".join(kept)).split())


def word_counts(page: str) -> dict[str, list[int]]:
    """Words inside and outside the labelled element by place; empty for unlabelled pages."""
    found = parts_of(page)
    counts: dict[str, list[int]] = {}
    if not any(p.inside for p in found):
        return counts
    for p in found:
        n = len(p.text.split())
        if p.name and p.name not in COMMENTS and n and not (p.silent or p.boxed):
            counts.setdefault(f"name {p.name}", [0, 0])[0 if p.inside else 1] += n
    parts = boxes_settled(found, Weights())
    for p, bare in zip(parts, unlabelled(parts), strict=True):
        n = len(p.text.split())
        if n and not p.silent:
            # Words of labelled pages also teach about places on pages that have no label.
            sized = [bare.place, *block_names(bare.place)[:1]]
            names = [p.place, *block_names(p.place), *sized, *map(any_block, sized), *block_names(bare.place)[1:]]
            for name in names:
                counts.setdefault(name, [0, 0])[0 if p.inside and not p.boxed else 1] += n
    return counts


def learn_weights(pages: DataFrame, *, html_col: str = "html", label_pages: int = LABEL_PAGES) -> Weights:
    """Learn the weights of places from a sample of about ``label_pages`` labelled pages.

    Sampled by hash of the page. The table of places has one row per distinct block name and
    class in the sample, so its size is bounded by it. Without labelled pages the weights
    are the prior ones.
    """
    labelled = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]")).select(
        F.col(html_col).alias("html"), F.xxhash64(html_col).alias("draw")
    )
    found = labelled.count()
    if not found:
        return Weights()
    share = min(1.0, label_pages / found)

    @F.arrow_udf("array<struct<place:string,inside:bigint,outside:bigint>>")
    def counted(batch: pa.Array) -> pa.Array:
        rows = []
        for page in batch.to_pylist():
            rows.append(
                [{"place": k, "inside": v[0], "outside": v[1]} for k, v in word_counts(page).items()]
            )
        kind = pa.list_(
            pa.struct([("place", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])
        )
        return pa.array(rows, kind)

    sums = (
        labelled.where(F.pmod("draw", F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))
        .select(F.inline(counted("html")))
        .groupBy("place")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )
    places, names = {}, {}
    # Places without their block come first: they are what is expected of those with one.
    for place, inside, outside in sorted(sums, key=lambda row: ">*" not in row["place"]):
        is_name = place.startswith("name ")
        expected = NAME_PRIOR if is_name else Weights(places).word(place)
        share_in = PRIOR_WORDS / (1 + math.exp(-expected))
        odds = (inside + share_in) / (outside + PRIOR_WORDS - share_in)
        weight = max(-4.0, min(4.0, math.log(odds)))
        if is_name:
            names[place.removeprefix("name ")] = weight
        else:
            places[place] = weight
    return Weights(places, names=names)


def extract_main_text(
    pages: DataFrame, weights: Weights, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``, from the whole page.

    Character references are decoded, white space within a block is one blank, blocks are joined
    by one blank in page order. A null, empty or wordless page has an empty text.
    """

    def extract(batch: pa.Array) -> pa.Array:
        return pa.array([main_text(page, weights) for page in batch.to_pylist()], pa.string())

    small_batches(pages.sparkSession)
    text = F.arrow_udf(extract, StringType())(F.coalesce(html_col, F.lit("")))
    return pages.select(id_col, url_col, text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
