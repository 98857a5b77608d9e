"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its tags with their path, and its text pieces with theirs. The
occurrence vector of a token is how often it occurs on each page of the host; tokens
with equal vectors form an equivalence class. The class that occurs once on every
page is the root of the template; other frequent classes nest in its slots, by the
elements their paths lead through. Text that shares a class with tags is page
furniture. Of the remaining slots those of the article are extracted: the root element
with most varying text, without the teasers in it. Article and main elements are
evidence for that choice; they decide alone only where a host has no template.

Vectors never travel: each is a 64-bit sum of (page, count) hashes that adds up in any
order, so a host of any size is summed before the shuffle.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table
from tidemark.plans.scratch import materialize

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table "
    "tbody tfoot thead title tr ul".split()
)
HIDDEN = (
    "audio button canvas datalist dialog footer head header iframe input label math nav noscript object select svg "
    "template textarea title video aside menu"
)
FURNITURE = frozenset(HIDDEN.split())
CLOSES_P = BLOCK - {"body", "head", "html", "option", "legend"}
# An element ends an open one of these when it starts (itself, unless listed otherwise).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
NOT_P = BLOCK - {"p"}
LISTS = frozenset({"ul", "ol", "dl", "table", "select", "menu"})
# Words in a class, id or role that mark page furniture.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|"
    r"sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toolbar|header|masthead|footer|"
    r"comment(?:s|list|lists|area|form)?|disqus|replies|reply|respond|share|sharing|social|related|recommended|login|signup|search|"
    r"complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Elements whose content is not markup, up to their end tag.
RAW = {name: re.compile(f"</{name}\\s*>", re.I) for name in "script style noscript template iframe textarea svg math xmp".split()}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>\"']*)(>?)")
STOP = re.compile("[>\"']")
# Elements nested deeper than this open nothing of their own, as in browsers; their text stays.
DEPTH = 512
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
ARTICLE, MAIN = 2, 1
# Path steps of articles and mains.
ARTICLE_STEP = r"article(?:[.#@]|$)|.*@article$"
REGION_STEP = r"(?:article|main)(?:[.#@]|$)|.*@(?:article|main)$"
IS_ARTICLE = re.compile(ARTICLE_STEP, re.S)
IS_ITEM = re.compile(r"/li(?:[.#@/]|$)")


@dataclass
class Block:
    """A block of text: its path, whether furniture holds it, the articles or mains around it, and how much is links.

    ``marks`` are the elements around it that words in a class, id or role mark: number on the page and path."""

    path: str
    furniture: bool
    region: int
    text: str
    linked: int
    marks: tuple[tuple[int, str], ...] = ()


@dataclass
class _Open:
    name: str
    path: str
    furniture: bool
    region: int
    link: bool
    marks: tuple[tuple[int, str], ...] = ()
    titled: bool = False  # the header of an article, whose headings belong to it


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    tags: Counter[str] = field(default_factory=Counter)
    wraps: dict[int, int] = field(default_factory=dict)  # the articles or mains in a marked element
    regions: bool = False


# Elements that no word marks.
UNMARKED = frozenset({"html", "body", "main", "article"})
COMPOUND, PLAIN, BARE = 1, 2, 3
# The share of the page's text from which on a mark is forgotten; a form without a paragraph or heading keeps its mark.
SHARE = {COMPOUND: 0.5, PLAIN: 0.9, BARE: 1.0}


def _label(name: str, rest: str) -> tuple[str, bool, int, int]:
    """Path step of a start tag, whether it is furniture, the region it opens, and what marks it (a compound or plain word, or being a form)."""
    furniture, region, step, said, words = name in FURNITURE, 0, name, "", BARE if name == "form" else 0
    if name == "article":
        region = ARTICLE
    elif name == "main":
        region = MAIN
    if rest.strip(" /"):
        for m in ATTRIBUTE.finditer(rest):
            kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip()
            if kind in ("class", "id", "role") and MARKS.search(value):
                plain = any(MARKS.fullmatch(x) for x in value.split())
                words = max(words, PLAIN if plain else COMPOUND)
            if kind in ("class", "id"):
                step += ("." if kind == "class" else "#") + value
            if kind == "role" and value in ("main", "article") or kind == "itemprop" and value == "articleBody":
                region = MAIN if value == "main" else ARTICLE
                said = "@main" if value == "main" else "@article"
            if kind == "hidden" or kind == "aria-hidden" and value == "true":
                furniture = True
    # A slash would look like another step.
    return step.replace("/", "\\") + said, furniture, region, 0 if name in UNMARKED or region else words


def _drop_marks(page: Page, strength: dict[int, int]) -> None:
    """Forget marks of elements around a main, and of those that hold most of the page's text (plain words and forms: nine tenths).

    On a page with articles or mains only elements in or around these can."""
    held, near, whole = Counter(), set(page.wraps), 0
    for b in page.blocks:
        if not b.furniture:
            own = max(0, len(b.text) - 2 * b.linked)
            whole += own
            for number, _ in b.marks:
                held[number] += own
                if b.region:
                    near.add(number)
    most = {n for n, own in held.items() if own > whole * SHARE[strength[n]]}
    lifted = {n for n, region in page.wraps.items() if region == MAIN} | (most & near if page.regions else most)
    for b in page.blocks:
        b.marks = tuple(m for m in b.marks if m[0] not in lifted)


def _markup(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, lower-case name (of comments and the like: empty), whether it is an end tag, and the rest of each piece of markup.

    Reads the source once. A raw element is one piece named ``!``. A ``>`` in quotes does not end a tag; from the first tag on
    whose quotes never end, quotes mean nothing. Without a further ``>`` the rest is text."""
    at, quotes = 0, True
    while True:
        start = source.find("<", at)
        if start < 0:
            return
        if source.startswith("<!--", start):
            stop = source.find("-->", start + 4)
            end = len(source) if stop < 0 else stop + 3
            yield start, end, "", False, ""
            at = end
            continue
        named = NAME.match(source, start)
        if not named and source[start + 1 : start + 2] not in ("!", "?"):
            at = start + 1
            continue
        end = named.end() if named and named[3] else source.find(">", start) + 1
        if not end:
            return
        if not named:
            yield start, end, "", False, ""
            at = end
            continue
        if quotes and not named[3]:
            stop = STOP.search(source, named.end())
            while stop and stop[0] != ">":
                closing = source.find(stop[0], stop.end())
                stop = STOP.search(source, closing + 1) if closing >= 0 else None
            quotes = stop is not None
            end = stop.end() if stop else end
        name, closes = named[1].lower(), source[start + 1] == "/"
        at = end
        if name in RAW and not closes:
            # A drawing may end in its start tag.
            if name not in ("svg", "math") or source[end - 2] != "/":
                stop = RAW[name].search(source, end)
                at = stop.end() if stop else len(source)
            name = "!"
        yield start, at, name, closes, source[named.end(1) : end - 1]


def parse(source: str | None) -> Page:
    """Blocks and start tags of a page, in order. Never fails: what is not markup is text, what stays open ends with its parent.

    Text of an inline element that is furniture or marked leaves its block and becomes a block of its own."""
    page, source = Page(), source or ""
    stack = [_Open("", "", False, 0, False)]
    opened: dict[str, int] = {}
    # Text since the last block began or ended, each with the innermost element around it and how much of it is a link.
    pieces: list[tuple[str, _Open, int]] = []
    strength: dict[int, int] = {}

    def flush() -> None:
        if not pieces:
            return
        if len(pieces) == 1:
            text, o, linked = pieces.pop()
            text = " ".join(text.split())
            if text:
                page.blocks.append(Block(stack[-1].path, o.furniture, o.region, text, linked, o.marks))
            return
        parts: dict[tuple, list[tuple[str, int]]] = {}
        for text, o, linked in pieces:
            parts.setdefault((o.furniture, o.region, o.marks), []).append((text, linked))
        for (furniture, region, marks), held in parts.items():
            text = " ".join("".join(t for t, _ in held).split())
            if text:
                page.blocks.append(Block(stack[-1].path, furniture, region, text, sum(n for _, n in held), marks))
        pieces.clear()

    def add(text: str) -> None:
        text = entities.unescape(text)
        pieces.append((text, stack[-1], len(text) if stack[-1].link else 0))

    def close(names: set[str], stops: frozenset[str], block: bool = True) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].name in names:
                if block:
                    flush()
                for o in stack[at:]:
                    opened[o.name] -= 1
                del stack[at:]
                return
            if stack[at].name in stops:
                return

    end = 0
    for start, stop, name, closes, rest in _markup(source):
        if start > end:
            add(source[end:start])
        end = stop
        if not name:
            continue
        if name == "!":
            pieces.append((" ", stack[-1], 0))
            continue
        if closes:
            if name in BLOCK:
                flush()
            if opened.get(name):
                # Inline ends stay within their block; block ends close what is open inside.
                close({name}, frozenset() if name in BLOCK else BLOCK, name in BLOCK)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            if name == "br":
                pieces.append((" ", stack[-1], 0))
            continue
        if name in BLOCK:
            flush()
        if name in CLOSES_P and opened.get("p"):
            close({"p"}, NOT_P)
        if name in ENDS:
            close(ENDS[name], LISTS)
        if name in ("td", "th"):
            pieces.append((" ", stack[-1], 0))
        if len(stack) > DEPTH:
            continue
        step, marked, region, words = _label(name, rest)
        top = stack[-1]
        # An inline step is not part of the path: text keeps the path of its block.
        path = f"{top.path}/{step}" if name in BLOCK else top.path
        titles = name == "header" and top.region == ARTICLE and not top.furniture
        furniture = marked or top.furniture and not (top.titled and name in HEADINGS)
        marks = top.marks
        if name in HEADINGS or name in ("p", "article", "main"):
            for number, _ in marks:
                if strength[number] == BARE:
                    strength[number] = PLAIN
        if words and not titles:
            # The mark of an inline element is its own, not that of its block.
            number = len(strength)
            strength[number] = words
            marks = (*marks, (number, path if name in BLOCK else f"{path}/{step}"))
        if name in BLOCK:
            page.tags[path] = page.tags.get(path, 0) + 1
        elif words or furniture and not top.furniture:
            pieces.append((" ", top, 0))
        if region and not furniture:
            page.regions = True
            # Teasers are articles too, but a main is one.
            page.wraps.update((n, min(region, page.wraps.get(n, region))) for n, _ in marks)
        titled = titles or top.titled and not marked
        opened[name] = opened.get(name, 0) + 1
        stack.append(_Open(name, path, furniture, max(top.region, region), top.link or name == "a", marks, titled))
    if end < len(source):
        add(source[end:])
    flush()
    _drop_marks(page, strength)
    return page


def _number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def hosted(pages: DataFrame) -> DataFrame:
    """``pages`` with the lower-case ``host`` of their url; empty without one."""
    authority = F.regexp_extract("url", r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.withColumn("host", F.coalesce(F.lower(authority), F.lit("")))


def page_tokens(pages: DataFrame) -> DataFrame:
    """Summed tokens of pages with ``host`` and ``html``: ``host``, ``token``, ``path`` (of a tag; null for text), ``at`` (the tag
    of a text), ``pages``, ``total``, ``vector`` and ``mass``.

    Pages with the same blocks outside of furniture count once, so copies of an article do not look like a template. Pages
    without tags have no say in one."""
    item = "token long, path string, at long, n long, mass long"
    schema = f"host string, digest long, items array<struct<{item.replace(' ', ':')}>>".replace(",:", ",")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for host, source in zip(pdf["host"], pdf["html"]):
                page = parse(source)
                if not page.tags:
                    continue
                text, mass, chars = Counter(), Counter(), Counter()
                for b in page.blocks:
                    own = 0 if b.furniture or b.marks else max(0, len(b.text) - 2 * b.linked)
                    text[b.path, b.text] += 1
                    chars[b.path, b.text] += own
                    mass[b.path] += own
                found = [(_number("tag", p), p, 0, n, mass[p]) for p, n in page.tags.items()]
                found += [(_number("text", *t), None, _number("tag", t[0]), n, chars[t]) for t, n in text.items()]
                found.append((0, "", 0, 1, 0))  # the page itself
                held = [x for b in page.blocks if not b.furniture and not b.marks for x in (b.path, b.text)]
                rows.append((host, _number("page", *held), [dict(zip(names, x)) for x in found]))
            yield pd.DataFrame(rows, columns=["host", "digest", "items"])

    names = [x.split()[0] for x in item.split(", ")]
    rows = pages.select("host", "html").mapInPandas(run, schema)
    distinct = rows.groupBy("host", "digest").agg(F.min("items").alias("items"))
    flat = distinct.select("host", "digest", F.inline("items"))
    return flat.groupBy("host", "token").agg(
        F.first("path").alias("path"), F.first("at").alias("at"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"),
        F.bit_xor(F.xxhash64("digest", "n")).alias("vector"), F.sum("mass").alias("mass"),
    )


def article_group(path: str, root: str) -> str | None:
    """The outermost article below ``root`` around ``path``, named without ids and digits; null outside of articles."""
    steps = path[len(root) + 1 :].split("/")
    for i, step in enumerate(steps):
        if IS_ARTICLE.match(step):
            # Posts carry numbers of their own in ids and classes.
            return "/".join(re.sub(r"#[^.@]*|\d+", "", x) for x in steps[: i + 1])
    return None


def _article_groups(tags: DataFrame) -> DataFrame:
    """``host``, ``grp`` (null: outside of articles), ``pages``, ``total`` and ``mass`` of the articles in each host's ``root``.

    ``listed`` is the part of the mass that items of lists outside of articles hold."""
    schema = "host string, grp string, pages long, total long, mass long, listed long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for host, path, root, pages, total, mass in zip(*(pdf[c] for c in columns)):
                group = article_group(path, root)
                opens = group is not None and article_group(path.rpartition("/")[0], root) is None
                listed = mass if group is None and IS_ITEM.search(path[len(root) :]) else 0
                rows.append((host, group, pages if opens else 0, total if opens else 0, mass, listed))
            yield pd.DataFrame(rows, columns=schema.replace(",", "").split()[::2])

    columns = ["host", "path", "root", "pages", "total", "mass"]
    rows = tags.select(*columns).mapInPandas(run, schema)
    return rows.groupBy("host", "grp").agg(*[F.sum(c).alias(c) for c in ("pages", "total", "mass", "listed")])


def templates(tokens: DataFrame, least_pages: int) -> DataFrame:
    """Per host: ``root`` (path of the element that holds the article, or null), ``only`` (the article group to take in it, or null),
    ``besides`` (article groups to leave out) and ``constant`` (text tokens of the template).

    Tokens of one vector are a class. A class is valid if it is frequent (on ``least_pages`` pages and half of the host's) and
    has a tag. Text in a valid class comes with a tag wherever that occurs, so it belongs to the template; all other text varies.
    Root elements occur once on nine tenths of the pages and never twice; paragraphs and headings are none. The deepest that holds
    nine tenths of the varying text is the slot of the article; for an article or main half of it is enough, and what is deduced inside of one is widened to it.
    In the slot the articles are held against the text outside of them: if one group of articles has most text, it alone is
    taken, and if not, groups that come several to a page are teasers. Lists do not count against an article that a page has once.
    Each constant token is on half of a host's pages, so a host has at most twice as many as a page has on average."""
    size = tokens.where("token = 0").select("host", F.col("pages").alias("size"))
    size = materialize(size, "hosts")
    frequent = (F.col("pages") >= least_pages) & (2 * F.col("pages") >= F.col("size"))
    joined = tokens.where("token <> 0").join(size, "host").where(F.col("size") >= least_pages)
    alike = ["host", "vector", "pages", "total"]
    valid = joined.where("path IS NOT NULL").where(frequent).select(*alike).distinct()
    constant = joined.where("path IS NULL").where(frequent).join(valid, alike, "left_semi")
    constant = materialize(constant.select("host", "token", "at", "mass"), "page-constants")
    fixed = constant.where("mass > 0").groupBy("host", F.col("at").alias("token")).agg(F.sum("mass").alias("_fixed"))
    tags = joined.where("path IS NOT NULL").join(fixed, ["host", "token"], "left")
    tags = materialize(tags.withColumn("mass", F.col("mass") - F.coalesce("_fixed", F.lit(0))).drop("_fixed", "at", "vector"), "page-tags")
    # Text of nested tags counts for every element around them.
    steps = F.split(F.substring("path", 2, 1 << 30), "/")
    prefix = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    around = tags.where("mass > 0").select("host", "mass", F.explode(prefix).alias("path"))
    around = around.groupBy("host", "path").agg(F.sum("mass").alias("mass"))
    once = (F.col("total") == F.col("pages")) & (10 * F.col("pages") >= 9 * F.col("size"))
    holds = ~F.element_at(steps, -1).rlike(r"^(?:p|h[1-6]|pre|blockquote)(?:[.#@]|$)")
    held = tags.where(once & holds).select("host", "path").join(around, ["host", "path"])
    held = materialize(held.withColumn("region", F.element_at(steps, -1).rlike(f"^(?:{REGION_STEP})")), "page-roots")
    whole = around.groupBy("host").agg(F.max("mass").alias("most"))
    deep = held.join(whole, "host").where("mass >= 0.9 * most OR (region AND mass >= 0.5 * most)")
    deepest = deep.groupBy("host").agg(F.max(F.struct(F.length("path").alias("depth"), "path")).alias("r"))
    deepest = deepest.select("host", F.col("r.path").alias("deepest"))
    inside = F.startswith(F.concat("deepest", F.lit("/")), F.concat("path", F.lit("/")))
    wider = held.where("region").join(deepest, "host").where(inside)
    wider = wider.groupBy("host").agg(F.max(F.struct(F.length("path").alias("depth"), "path")).alias("w"))
    root = deepest.join(wider, "host", "left").select("host", F.coalesce("w.path", "deepest").alias("root"))
    root = materialize(root, "page-slots")

    # An article is taken whole.
    open_ = root.where(~F.element_at(F.split("root", "/"), -1).rlike(f"^(?:{ARTICLE_STEP})"))
    within = F.startswith(F.concat("path", F.lit("/")), F.concat("root", F.lit("/")))
    groups = materialize(_article_groups(tags.join(open_, "host").where(within)), "page-articles").join(size, "host")
    several = F.greatest(F.col("total") - F.col("pages"), F.col("total") - F.col("size")) > 0
    article, besides = F.col("grp").isNotNull(), F.when(F.col("grp").isNotNull() & several, F.col("grp"))
    choice = groups.groupBy("host").agg(
        F.max(F.when(article, F.struct("mass", "grp", several.alias("several")))).alias("best"),
        F.coalesce(F.sum(F.when(~article, F.col("mass"))), F.lit(0)).alias("rest"), F.sum("listed").alias("listed"),
        F.collect_set(besides).alias("besides"),
    )
    # Comments are items of a list beside the one article.
    against = F.col("rest") - F.when(F.col("best.several"), 0).otherwise(F.col("listed"))
    choice = choice.select("host", F.when(F.col("best.mass") > against, F.col("best.grp")).alias("only"), "besides")
    constant = constant.groupBy("host").agg(F.collect_set("token").alias("constant"))
    return size.select("host").join(root, "host", "left").join(choice, "host", "left").join(constant, "host", "left")


def _marked(own: list[Block]) -> list[Block]:
    """What article and main elements hold, or else all."""
    for region in (ARTICLE, MAIN):
        inside = [b for b in own if b.region >= region]
        if inside:
            return inside
    return own


def main_blocks(
    source: str | None, root: str | None, constant: set[int], only: str | None = None, besides: frozenset[str] = frozenset()
) -> list[str]:
    """Blocks of the article, in page order. A page without the template's ``root`` is read by its marks alone."""
    page = parse(source)
    own = [b for b in page.blocks if not b.furniture]
    if root and root in page.tags:
        # The template overrules marks around its slot.
        own = [b for b in own if all(f"{root}/".startswith(path + "/") for _, path in b.marks)]
        own = [b for b in own if b.path == root or b.path.startswith(root + "/")]
        groups = [article_group(b.path, root) for b in own]
        if only in groups:
            own = [b for b, g in zip(own, groups) if only is None and g not in besides or only is not None and g == only]
    else:
        own = _marked([b for b in own if not b.marks])
    return [b.text for b in own if _number("text", b.path, b.text) not in constant]


def extract(pages: DataFrame, key: str = "page_id", least_pages: int = 10) -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every page.

    Blocks of the main text are joined by one line feed; inside a block white space is one space. Null, empty and
    textless pages have an empty text and 0 characters. Pages without a host share one. A host with fewer than
    ``least_pages`` pages of different content has no template; its pages are read by their marks alone. A null or repeated key is a row like any
    other. An empty table gives no rows; other columns are not read. Time and memory of a page grow with its length, whatever it holds.
    """
    pages = hosted(pages.select(key, "url", "html"))
    tokens = materialize(page_tokens(pages), "page-tokens")
    found = materialize(templates(tokens, least_pages), "templates")
    schema = T.StructType(
        [pages.schema[key], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            known: dict[str, set[int]] = {}
            for name, url, source, host, root, only, besides, constant in zip(*(pdf[c] for c in columns)):
                if host not in known:
                    known[host] = set(np.asarray(constant).tolist()) if constant is not None else set()
                left_out = frozenset(besides if besides is not None else ())
                text = "\n".join(main_blocks(source, root, known[host], only, left_out))
                rows.append((name, url, text, len(text)))
            yield pd.DataFrame(rows, columns=schema.names).astype({key: pdf[key].dtype})

    columns = [key, "url", "html", "host", "root", "only", "besides", "constant"]
    return pages.join(found, "host", "left").select(*columns).mapInPandas(run, schema)


def pages_query(spark, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
